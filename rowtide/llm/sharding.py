"""Shards by a Feistel permutation with cycle walking over global row numbers (native)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import numbered

#: The round function works modulo this prime, so that its squares fit a long.
PRIME = 2**31 - 1
ROUNDS = 6
WALKS = 64


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """Keys of the rounds from a linear congruence on the seed."""
    keys, x = [], (seed * 2 + 1) % PRIME
    for _ in range(rounds):
        x = (x * 48271 + 11) % PRIME
        keys.append(x)
    return keys


def radixes(n: int) -> tuple[int, int]:
    """Two factors whose product is at least ``n`` and exceeds it by less than the larger one."""
    a = max(1, math.isqrt(n - 1) + 1) if n > 1 else 1
    return a, max(1, -(-n // a))


def permuted(row: int, n: int, seed: int) -> int:
    """The place of a row number, as plain arithmetic: no table is needed to find a row's shard."""
    a, b = radixes(n)
    while True:
        left, right, ml, mr = row // b, row % b, a, b
        for k in round_keys(seed):
            x = (right % PRIME + k) % PRIME
            x = (x * x % PRIME) * x % PRIME
            left, right, ml, mr = right, (left + x) % ml, mr, ml
        row = left * mr + right
        if row < n:
            return row


def original(place: int, n: int, seed: int) -> int:
    """The row number at a place: the inverse of ``permuted``."""
    a, b = radixes(n)
    while True:
        ml, mr = (a, b) if ROUNDS % 2 == 0 else (b, a)
        left, right = place // mr, place % mr
        for k in reversed(round_keys(seed)):
            x = (left % PRIME + k) % PRIME
            x = (x * x % PRIME) * x % PRIME
            left, right, ml, mr = (right - x) % mr, left, mr, ml
        place = left * b + right
        if place < n:
            return place


def permutation(row: Column, n: int, seed: int) -> Column:
    """``permuted`` as a column expression over row numbers below ``n``.

    The two factors overshoot ``n`` by less than the larger one, so a walk leaves the range at
    most that often; up to 4096 rows 64 steps are enough for certain, and beyond a walk of 64
    steps has a chance below 64^-64. A longer one would raise an error.
    """
    a, b = radixes(n)
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed)])

    def number(c) -> Column:
        return F.lit(c).cast("long")

    def cube(x: Column) -> Column:
        return F.pmod(F.pmod(x * x, number(PRIME)) * x, number(PRIME))

    def one_round(s: Column, k: Column) -> Column:
        x = cube(F.pmod(F.pmod(s["r"], number(PRIME)) + k, number(PRIME)))
        return F.struct(
            s["r"].alias("l"), F.pmod(s["l"] + x, s["ml"]).alias("r"), s["mr"].alias("ml"), s["ml"].alias("mr")
        )

    def shuffle_once(p: Column) -> Column:
        first = F.struct(
            F.call_function("div", p, number(b)).alias("l"),
            F.pmod(p, number(b)).alias("r"),
            number(a).alias("ml"),
            number(b).alias("mr"),
        )
        return F.aggregate(keys, first, one_round, lambda s: s["l"] * s["mr"] + s["r"])

    steps = F.sequence(F.lit(1), F.lit(WALKS))
    walked = F.aggregate(steps, shuffle_once(row), lambda p, _: F.when(p < number(n), p).otherwise(shuffle_once(p)))
    return F.when(walked < number(n), walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def shard_rows(docs: DataFrame, shards: int, seed: int, order: list[str]) -> DataFrame:
    """``docs`` with ``row_no``, ``place``, ``shard`` and ``slot``; shard sizes differ by one at most.

    Row numbers follow ``order`` (nulls first), so the same rows give the same shuffle in every run;
    rows equal in all of ``order`` are interchangeable. ``place`` is the permuted row number,
    shard its remainder and slot its quotient by ``shards``; ``permuted`` computes both for any row
    and ``original`` finds the row of a shard's slot without reading anything. An empty table gives no rows.
    """
    rows = numbered(docs, order)
    n = rows.count()
    placed = rows.withColumn("place", permutation(F.col("row_no"), n, seed)) if n else rows.withColumn("place", F.lit(0).cast("long"))
    return placed.withColumns(
        {
            "shard": F.pmod("place", F.lit(shards)).cast("int"),
            "slot": F.call_function("div", F.col("place"), F.lit(shards)).cast("long"),
        }
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): its size, checksum, shard and slot.

    Size is the UTF-8 length plus 1; a null text counts as empty. The law is ``rows``: counts differ by
    one at most, so ``grown_shard`` is null. Documents with equal ids are ordered by checksum and size.
    Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    out = shard_rows(narrow, shards, seed, ["doc_id", "text_crc32", "size"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_no"
    )
