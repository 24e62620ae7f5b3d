"""Targets other than the keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import child_folders
from rowtide.sources.merge_store import BUCKET, bucket_of


def append_rows(df: DataFrame, path: str) -> None:
    """Rows of a table without a key are only ever added."""
    df.write.mode("append").parquet(path)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row encoded as one JSON object, null fields left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON Lines: one object per line, no enclosing array."""
    df.write.mode("overwrite").json(path)


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, bucket: Column | None = None
) -> None:
    """Rows hash-distributed by key into folders; ``bucket`` replaces the hash by another rule.

    A key that repeats often fills its bucket: rebalancing splits such a bucket over tasks and files.
    """
    placed = df.withColumn(BUCKET, bucket if bucket is not None else bucket_of(keys, buckets))
    placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def write_catalog_version(catalog: DataFrame, path: str, environment: str, job: str, version: int) -> None:
    """Keep the catalog of one run; earlier versions stay for later comparison."""
    catalog.write.mode("overwrite").json(f"{path}/environment={environment}/job={job}/version={version}")


def read_catalog_versions(spark: SparkSession, path: str, schema) -> DataFrame:
    """Catalogs of all runs with their environment, job and version."""
    return spark.read.schema(schema).option("basePath", path).json(path)


def latest_catalog(spark: SparkSession, path: str, schema, environment: str, job: str) -> DataFrame:
    """The newest catalog kept for a job, found by the names of its folders; no older one is read."""
    kept = f"{path}/environment={environment}/job={job}"
    versions = [int(n.removeprefix("version=")) for n in child_folders(spark, kept) if n.startswith("version=")]
    if not versions:
        return read_catalog_versions(spark, path, schema).limit(0) if child_folders(spark, path) else spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).json(f"{kept}/version={max(versions)}")


def write_report(report: DataFrame, path: str) -> None:
    """The nested analysis report as JSON, a folder per section."""
    report.write.mode("overwrite").partitionBy("section").json(path)
