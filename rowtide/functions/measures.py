"""Numeric rules of the activity analysis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ratio shown for an entity that is read but never written.
READ_ONLY_RATIO = 999999.0
# Default write thresholds of the tiers.
HIGH_WRITES = 100_000
LOW_WRITES = 10_000
# Ten locks weigh as one operation; a row is estimated as ten operations.
LOCKS_PER_OPERATION = 10
OPERATIONS_PER_ROW = 10
# Fixed value: size of a storage page in KB.
PAGE_KB = 8

TIERS = ("high", "medium", "low")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def safe_number(value: Column, kind: str = "bigint") -> Column:
    """The value as a number, 0 where it is missing or no number."""
    return F.coalesce(value.try_cast(kind), F.lit(0).cast(kind))


def read_write_ratio(reads: Column, writes: Column) -> Column:
    return (
        F.when((writes == 0) & (reads > 0), F.lit(READ_ONLY_RATIO))
        .when(writes > 0, reads.cast("double") / writes.cast("double"))
        .otherwise(F.lit(0.0))
    )


def tier(metric: Column, high: int = HIGH_WRITES, low: int = LOW_WRITES) -> Column:
    return F.when(metric >= high, "high").when(metric >= low, "medium").otherwise("low")


def lock_weighted_io(reads: Column, writes: Column, locks: Column) -> Column:
    return reads + writes + F.call_function("div", locks, F.lit(LOCKS_PER_OPERATION))


def latest_of(*times: Column) -> Column:
    """Newest of several nullable times; null only where all are."""
    return F.greatest(*times)
