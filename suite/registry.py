"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query registered twice: {key}")
        REGISTRY[key] = Entry(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
