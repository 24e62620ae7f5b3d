"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import ascii_lower, stored
from rowtide.session import broadcast_if_small


def normal_text(text: str | Column = "text") -> Column:
    """What is compared: A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def full_hash(text: str | Column = "text") -> Column:
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(F.encode(normal_text(text), "UTF-8"), 256)


def _n_bytes() -> Column:
    return F.octet_length(F.coalesce("text", F.lit(""))).cast("long")


def _prefix_hash(chars: int = 64) -> Column:
    return F.xxhash64(ascii_lower(F.substring(F.coalesce("text", F.lit("")), 1, chars)))


def refined(docs: DataFrame, prefix_chars: int = 64, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, ``n_bytes``, ``prefix_hash``, ``full`` per row of ``docs`` and the ``carry`` columns, stored.

    ``full`` is the full hash and null for a text whose length, or length and prefix, occurs once: such a
    text is never hashed whole. Groups are counted, never gathered; the keys that occur twice
    or more reach the second scan by broadcast while small (checked), else by a shuffle join.
    """
    n_bytes, prefix = _n_bytes(), _prefix_hash(prefix_chars)
    heads = stored(docs.select(n_bytes.alias("n_bytes"), prefix.alias("prefix_hash")), "heads")
    lengths = heads.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    keys = (
        heads.join(lengths, "n_bytes", "left_semi").groupBy("n_bytes", "prefix_hash").count().where("count > 1").select("n_bytes", "prefix_hash", F.lit(True).alias("_again"))
    )
    keys = broadcast_if_small(stored(keys, "keys"))
    seen = docs.select("doc_id", "text", n_bytes.alias("n_bytes"), prefix.alias("prefix_hash"))
    seen = seen.join(keys, ["n_bytes", "prefix_hash"], "left")
    out = seen.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        "prefix_hash",
        F.when(F.col("_again"), full_hash()).alias("full"),
        *[c.alias(k) for k, c in (carry or {}).items()],
    )
    return stored(out, "refined")


def exact_classes(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, ``keep_id``, ``group_size``, ``kept`` and the ``carry`` columns.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest doc_id of
    equal texts stays. A null doc_id is smaller than any other. Of rows repeating both id and text
    one is kept. ``carry`` holds expressions over ``docs`` that equal texts share. An empty table gives no rows.
    """
    names = list(carry or {})
    rows = refined(docs, carry=carry)
    alone = rows.where("full is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *names
    )
    alive = rows.where("full is not null")
    same = alive.groupBy("full", "doc_id").agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in names])
    groups = alive.groupBy("full").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    many = same.join(groups, "full").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    many = many.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1))
    return alone.unionByName(many.select("doc_id", "keep_id", "group_size", "kept", *names))


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that ``exact_classes`` drops; all columns stay.

    Rows repeating both id and text are reduced to one of them. Only texts whose length and prefix are those of a group
    that loses rows, and that share a doc_id with it, are hashed whole again.
    """
    alive = refined(docs).where("full is not null")
    groups = alive.groupBy("full").agg(F.max("doc_id").alias("_keep"), F.count("*").alias("_rows"))
    groups = groups.where("_rows > 1")
    ids = alive.groupBy("full", "n_bytes", "prefix_hash", "doc_id").agg(F.count("*").alias("_n"))
    marked = stored(ids.join(groups, "full").select("full", "n_bytes", "prefix_hash", F.col("doc_id").alias("_id"), F.col("_id").eqNullSafe(F.col("_keep")).alias("_stays"), "_n"), "marked")
    # the row as one struct, so that no column of it can clash
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), _n_bytes().alias("row_bytes"), _prefix_hash().alias("row_prefix"))

    def on(side: DataFrame) -> Column:
        same = (keyed["row_bytes"] == side["n_bytes"]) & (keyed["row_prefix"] == side["prefix_hash"]) & keyed["row_id"].eqNullSafe(side["_id"])
        # both are 64 characters; an equality would be a join key, and those are computed for every row
        return same & F.contains(full_hash(keyed["row"]["text"]), side["full"])

    gone = broadcast_if_small(marked.where("not _stays or _n > 1"))
    kept = keyed.join(gone, on(gone), "left_anti")
    twice = broadcast_if_small(marked.where("_stays and _n > 1"))
    one = keyed.join(twice, on(twice), "left_semi").withColumn("row_full", full_hash(F.col("row.text"))).dropDuplicates(["row_full", "row_id"])
    return kept.unionByName(one.drop("row_full")).select("row.*")
