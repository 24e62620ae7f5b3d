"""Conformance of rows to declared types, and quality of keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.conversions import ColumnSpec, converted, is_mapped, violations
from rowtide.functions.digests import additive_digest, digest_of

VIOLATIONS = ("failed_cast", "null_in_not_null", "over_length")


def _bound(df: DataFrame, specs: Sequence[ColumnSpec]) -> list[ColumnSpec]:
    """Declarations that know how their columns are stored."""
    return [replace(spec, stored_as=df.schema[spec.name].dataType.simpleString()) for spec in specs]


def conform(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Cast declared columns to their mapped types; columns without declaration pass unchanged."""
    declared = {spec.name: spec for spec in _bound(df, specs)}
    return df.select(
        *[converted(F.col(c), declared[c]).alias(c) if c in declared else F.col(c) for c in df.columns]
    )


def conformance_report(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Per declared column: rows, nulls, failed casts, nulls not allowed, values too long.

    One pass over the data; the single result row is then turned into one row per column.
    """
    totals = [F.count(F.lit(1)).alias("_rows")]
    entries = []
    for i, spec in enumerate(_bound(df, specs)):
        value = F.col(spec.name)
        tests = violations(value, spec) | {"n_nulls": value.isNull()}
        for name, test in tests.items():
            totals.append(F.count_if(test).alias(f"_{i}_{name}"))
        counted = [
            (F.col(f"_{i}_{name}") if name in tests else F.lit(0).cast("bigint")).alias(name)
            for name in ("n_nulls", *VIOLATIONS)
        ]
        entries.append(
            F.struct(
                F.lit(spec.name).alias("column_name"),
                F.lit(spec.source_type).alias("source_type"),
                F.lit(is_mapped(spec.source_type)).alias("is_mapped"),
                F.col("_rows").alias("n_rows"),
                *counted,
            )
        )
    return df.agg(*totals).select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def with_reasons(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Rows with ``reasons``, an array of ``column:violation``; empty where all values fit."""
    found = [
        F.when(test, F.lit(f"{spec.name}:{name}"))
        for spec in _bound(df, specs)
        for name, test in violations(F.col(spec.name), spec).items()
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*found)))


def quarantine(df: DataFrame, specs: Sequence[ColumnSpec]) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, conformed, and rows that do not, with their reasons."""
    tagged = with_reasons(df, specs)
    valid = conform(tagged.where(F.size("reasons") == 0).drop("reasons"), specs)
    return valid, tagged.where(F.size("reasons") > 0)


def key_quality(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, keys, rows with a null in the key, keys that repeat and the rows beyond the first.

    ``is_unique`` tells whether the key can carry an upsert; otherwise the table is appended.
    """
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_null", some_null)
    whole = ~F.col("_null")
    total = F.sum("_n")

    def or_0(c):
        return F.coalesce(c, F.lit(0)).cast("bigint")

    return per_key.agg(
        or_0(total).alias("n_rows"),
        F.count_if(whole).alias("n_keys"),
        or_0(F.sum(F.when(F.col("_null"), F.col("_n")))).alias("null_key_rows"),
        F.count_if(whole & (F.col("_n") > 1)).alias("duplicate_keys"),
        or_0(F.sum(F.when(whole, F.col("_n") - 1))).alias("surplus_rows"),
    ).withColumn("is_unique", (F.col("null_key_rows") == 0) & (F.col("surplus_rows") == 0))


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Digest of a table (or of each group of it) that does not depend on row order."""
    chosen = list(columns or [c for c in df.columns if c not in by])
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), additive_digest(digest_of(df, chosen)).alias("fingerprint")
    )
