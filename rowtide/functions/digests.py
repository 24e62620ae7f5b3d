"""Row digests that are unambiguous, and sums of them that do not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

#: A digest's 64 hex digits are summed in slices of so many.
SLICE = 16
#: Digits of a slice that are summed together.
PARTS = (6, 5, 5)


def _plain_text(value: Column, kind: DataType | None) -> Column:
    if isinstance(kind, ArrayType):
        parts = F.transform(value, lambda x: field_text(x, kind.elementType))
    elif isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat(field_text(e["key"], kind.keyType), field_text(e["value"], kind.valueType)))
        parts = F.array_sort(pairs)
    elif isinstance(kind, StructType):
        text = F.concat(F.lit(""), *[field_text(value[f.name], f.dataType) for f in kind.fields])
        return F.when(value.isNotNull(), text)
    elif isinstance(kind, (FloatType, DoubleType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # -0.0 is 0.0
    else:
        return value.cast("string")
    return F.concat(F.size(value).cast("string"), F.lit("/"), F.array_join(parts, ""))


def field_text(value: Column, kind: DataType | None = None) -> Column:
    """Length-prefixed text, so that no two different rows share a concatenation; null is ``-``.

    With its type given, every element of an array, map or struct is written the same way, map entries in
    the order of their text; without, the value must be a plain one.
    """
    text = _plain_text(value, kind)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_text(columns: Sequence[Column], kinds: Sequence[DataType] | None = None) -> Column:
    return F.concat(*[field_text(c, k) for c, k in zip(columns, kinds or [None] * len(columns))])


def row_digest(columns: Sequence[Column], kinds: Sequence[DataType] | None = None) -> Column:
    """SHA-256 of a row as hex."""
    return F.sha2(row_text(columns, kinds), 256)


def digest_of(df: DataFrame, names: Sequence[str]) -> Column:
    """SHA-256 of some columns of ``df``, of any type."""
    return row_digest([F.col(n) for n in names], [df.schema[n].dataType for n in names])


def _slice_total(digest: Column, at: int) -> Column:
    """Aggregate: the sum of one slice of hex digests, exact. Its parts are summed as longs, enough for 2^39 rows of a group."""
    start, left, total = at * SLICE + 1, SLICE, F.lit(0).cast("decimal(38,0)")
    for width in PARTS:
        left -= width
        part = F.sum(F.conv(F.substring(digest, start, width), 16, 10).cast("bigint"))
        total = total + part.cast("decimal(20,0)") * F.lit(Decimal(16**left))
        start += width
    return total


def additive_digest(digest: Column) -> Column:
    """Aggregate: an order-insensitive digest of many rows that combines before the shuffle.

    Count and the sum of each slice, so every digit of the digests has a part in it.
    """
    totals = [_slice_total(digest, k).cast("string") for k in range(64 // SLICE)]
    return F.concat_ws("-", F.count(F.lit(1)).cast("string"), *totals)
