"""Snapshots of source tables, whole or in chunks of the key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from rowtide.operators.ranking import ranked

# Default chunk size, rows per fetch and connections of a chunked snapshot.
CHUNK_SIZE = 10_000
FETCH_SIZE = 1024
CONNECTIONS = 20


def snapshot(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """All rows of a table with the chosen columns; the scan reads no others."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def key_bounds(df: DataFrame, key: str) -> tuple[int, int] | None:
    """Least and greatest key: one aggregate over the key column, two numbers to the driver."""
    row = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def chunk_of(key: Column, lowest: int, size: int = CHUNK_SIZE) -> Column:
    return F.call_function("div", key - F.lit(lowest), F.lit(size)).cast("bigint")


def chunk_plan(df: DataFrame, key: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Chunks of an even split of the key range that hold rows: id, first and last key, rows."""
    bounds = key_bounds(df, key)
    lowest = bounds[0] if bounds else 0
    return df.groupBy(chunk_of(F.col(key), lowest, size).alias("chunk_id")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n_rows")
    )


def chunked_snapshot(df: DataFrame, key: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Snapshot rows with their chunk. A key has one chunk, and the chunks make up the table.

    Files are split by Spark itself, so one scan serves all chunks and nothing is shuffled.
    """
    bounds = key_bounds(df, key)
    lowest = bounds[0] if bounds else 0
    return df.withColumn("chunk_id", chunk_of(F.col(key), lowest, size))


def in_source_order(df: DataFrame, key: str, collation: str | None) -> DataFrame:
    """``df`` with a text key under the collation its source compares it by (``UTF8_LCASE``, ``UNICODE_CI``, …; none: by bytes)."""
    return df.withColumn(key, F.collate(key, collation)) if collation else df


def key_chunk_plan(df: DataFrame, key: str, size: int = CHUNK_SIZE, collation: str | None = None) -> DataFrame:
    """Chunks by rank of the key, for keys of any orderable type: id, first and last key, rows.

    ``size`` distinct keys in order make a chunk; a null key is the first. With ``collation`` keys that the source takes for equal
    are one key, and the order is the source's.
    """
    keys = in_source_order(df.select(key), key, collation).groupBy(key).agg(F.count("*").alias("_n"))
    numbered = ranked(keys, [], [key], rank="_rn").withColumn("chunk_id", chunk_of(F.col("_rn"), 1, size))
    return numbered.groupBy("chunk_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.sum("_n").alias("n_rows"))


def key_chunked_snapshot(df: DataFrame, key: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Snapshot rows with the chunk of :func:`key_chunk_plan` their key lies in; rows are shuffled once, by ranges of the key."""
    return ranked(df, [], [key], rank="_rn", dense=True).withColumn("chunk_id", chunk_of(F.col("_rn"), 1, size)).drop("_rn")


def sql_literal(value: object, quote: str = "'", binary: str = "0x{}") -> str:
    """A key value in the source's SQL; ``binary`` is its form of a byte string, with hex digits put in."""
    if isinstance(value, (bytes, bytearray)):
        return binary.format(bytes(value).hex().upper())
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return quote + str(value).replace(quote, quote * 2) + quote


def key_ranges(lows: Sequence[object], literal: Callable[[object], str], key: str) -> list[str]:
    """Conditions of the ranges between ascending first keys; the first is open below and takes nulls, the last open above."""
    texts = [literal(v) for v in lows[1:]]
    if not texts:
        return ["1 = 1"]
    first = f"({key} < {texts[0]} OR {key} IS NULL)"
    return [first, *[f"({key} >= {a} AND {key} < {b})" for a, b in zip(texts, texts[1:])], f"{key} >= {texts[-1]}"]


def jdbc_predicates(plan: DataFrame, key: str, quote: str = "'", binary: str = "0x{}") -> list[str]:
    """One condition per chunk of a plan, for ``spark.read.jdbc(predicates=...)``.

    Together they take every row once if the plan was made in the order the source compares the key by: for text give
    :func:`key_chunk_plan` the source's collation, or use :func:`hash_predicates`, which need no order. The list is as long
    as the plan has chunks; choose ``size`` so that those are few.
    """
    chunks = plan.orderBy("chunk_id").select("lo").collect()
    return key_ranges([r.lo for r in chunks], lambda v: sql_literal(v, quote, binary), key)


def hash_predicates(hashed: str, chunks: int) -> list[str]:
    """One condition per chunk by a hash in the source's SQL (such as ``CHECKSUM(guid)``), whatever order it compares keys in.

    The hash must be a whole number; rows where it is null are in the first chunk.
    """
    place = f"({hashed}) % {chunks}"
    # a remainder has the sign of its dividend in most dialects
    return [f"({place} = 0 OR ({hashed}) IS NULL)", *[f"{place} IN ({k}, {k - chunks})" for k in range(1, chunks)]]


def read_chunks(df: DataFrame, key: str, lowest: int, first: int, last: int, size: int = CHUNK_SIZE) -> DataFrame:
    """Rows of the chunks ``first`` to ``last``, as a key range the scan can skip files by."""
    return df.where((F.col(key) >= lowest + first * size) & (F.col(key) < lowest + (last + 1) * size))


def jdbc_chunk_options(
    options: Mapping[str, str],
    key: str,
    bounds: tuple[int, int],
    size: int = CHUNK_SIZE,
    connections: int = CONNECTIONS,
) -> dict[str, str]:
    """Options of Spark's JDBC source for a parallel snapshot over even key ranges.

    Ranges are at least one chunk wide and no more than the connections the source should see.
    """
    lowest, highest = bounds
    chunks = max(1, -(-(highest - lowest + 1) // size))
    return dict(options) | {
        "partitionColumn": key,
        "lowerBound": str(lowest),
        "upperBound": str(highest + 1),
        "numPartitions": str(min(chunks, connections)),
        "fetchsize": str(FETCH_SIZE),
    }


def jdbc_snapshot(
    spark: SparkSession,
    options: Mapping[str, str],
    key: str | None = None,
    columns: Sequence[str] | None = None,
    size: int = CHUNK_SIZE,
    connections: int = CONNECTIONS,
    collation: str | None = None,
    hashed: str | None = None,
) -> DataFrame:
    """Snapshot of a database table, read in parallel parts.

    A whole-number key is cut into even ranges. Keys of other types (text, GUID, binary, decimal) are cut by rank in the source's
    order: name the ``collation`` it compares text by, or give ``hashed``, a whole-number hash in its SQL, and parts need no order.
    A text key without either is an error, as parts in another order would lose or double rows.
    """
    plain_options = dict(options) | {"fetchsize": str(FETCH_SIZE)}
    plain = spark.read.format("jdbc").options(**plain_options).load()
    if hashed:
        plain = _jdbc_parts(spark, plain_options, hash_predicates(hashed, connections))
    elif key and isinstance(plain.schema[key].dataType, IntegralType):
        bounds = key_bounds(plain, key)
        if bounds:
            plain = spark.read.format("jdbc").options(**jdbc_chunk_options(options, key, bounds, size, connections)).load()
    elif key:
        if isinstance(plain.schema[key].dataType, StringType) and not collation:
            raise ValueError(f"text key {key}: name the collation its source compares it by (UTF8_BINARY for bytes), or give a hash")
        plan = key_chunk_plan(plain, key, size, collation)
        # chunks are joined so that the source sees no more connections than wanted
        chunks = plan.agg(F.max("chunk_id")).first()[0]
        together = -(-((chunks or 0) + 1) // connections)
        plan = plan.where(F.col("chunk_id") % together == 0)
        plain = _jdbc_parts(spark, plain_options, jdbc_predicates(plan, key))
    return plain.select(*columns) if columns else plain


def _jdbc_parts(spark: SparkSession, options: Mapping[str, str], predicates: list[str]) -> DataFrame:
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)
