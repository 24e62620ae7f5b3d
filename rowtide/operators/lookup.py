"""Lookups into mappings, and membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import broadcast_if_small, pinned


def union_with_priority(defaults: DataFrame, custom: DataFrame, on: Sequence[str], custom_wins: bool = True) -> DataFrame:
    """Default entries and custom entries with one row per key; ``custom_wins`` settles conflicts."""
    ranked = defaults.withColumn("_p", F.lit(0)).unionByName(
        custom.withColumn("_p", F.lit(-1 if custom_wins else 1))
    )
    return _first_by(ranked, on, ["_p"]).drop("_p")


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in {*keys, *order}]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def lookup_first_match(df: DataFrame, mapping: DataFrame, on: Sequence[str], priority: str = "priority") -> DataFrame:
    """Each row with the first mapping entry of its key; rows without one keep nulls.

    The mapping is cut to one row per key before the join, so rows are neither multiplied nor ranked.
    It is broadcast when counting shows it to be short; a long one joins by shuffle.
    """
    first = broadcast_if_small(pinned(_first_by(mapping, on, [priority])))
    return df.join(first, list(on), "left")


def array_membership(df: DataFrame, groups: DataFrame, column: str, members: str) -> DataFrame:
    """Rows with the group whose member array holds their value: explode, then an equi-join."""
    flat = groups.withColumn(column, F.explode(members)).drop(members)
    return df.join(flat, column, "left")
