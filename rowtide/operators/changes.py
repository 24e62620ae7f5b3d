"""Applying a feed of changes to a keyed table.

A change row holds the key and payload columns plus ``op`` (``r`` snapshot read, ``c`` insert,
``u`` update, ``d`` delete) and ``seq``, which grows with every change of a key. A *state* frame
has the same columns with one row per key; a row with op ``d`` is a tombstone.

Everything rests on one associative rule: of two rows of a key the later one stays. "Later" is a
total order (``seq``, then op, then payload), so any split or order of a feed gives the same state.
Keys match null-safe: all rows with the same null in a key are one key. Payload columns may be of any type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from rowtide.functions.digests import digest_of, field_text, row_text
from rowtide.session import pinned

SEQ = "seq"
OP = "op"
READ, CREATE, UPDATE, DELETE = "r", "c", "u", "d"
# Among changes of equal seq a delete comes last and a snapshot read first.
_OP_ORDER = (READ, CREATE, UPDATE, DELETE)


def op_rank(op: Column) -> Column:
    """Place of an op among changes of equal seq; an op that is none of the four, or null, is an error."""
    place = F.nullif(F.array_position(F.array(*[F.lit(o) for o in _OP_ORDER]), op), F.lit(0))
    refused = F.raise_error(F.concat(F.lit("a change's op is one of r, c, u, d, not "), F.coalesce(op, F.lit("null"))))
    return F.coalesce(place, refused.cast("bigint"))


def known_ops(changes: DataFrame, op: str = OP) -> tuple[DataFrame, DataFrame]:
    """Changes with one of the four ops, and all others, to be kept elsewhere; to apply those is an error."""
    known = F.coalesce(F.col(op).isin(*_OP_ORDER), F.lit(False))
    return changes.where(known), changes.where(~known)


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType)) or (isinstance(kind, ArrayType) and _has_map(kind.elementType))


def unordered(schema: StructType) -> list[str]:
    """Columns whose type has no order (maps, or types that hold one)."""
    return [f.name for f in schema.fields if _has_map(f.dataType)]


def change_order(schema: StructType, keys: Sequence[str], seq: str = SEQ, op: str = OP) -> Column:
    """Struct whose maximum is the latest change of a key; payload columns settle ties, maps by their text."""
    odd = unordered(schema)
    payload = [c for c in schema.names if c not in {*keys, seq, op}]
    fields = [(field_text(F.col(c), schema[c].dataType) if c in odd else F.col(c)).alias(c) for c in (op, *payload)]
    return F.struct(F.col(seq).alias(seq), op_rank(F.col(op)).alias("_rank"), *fields)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the null-safe condition that joins it to ``left``."""
    right = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    return right, reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_key_{k}"]) for k in keys])


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    right, on = same_keys(left, right, keys)
    return left.join(right, on, how).drop(*[f"_key_{k}" for k in keys])


def latest_change_per_key(
    changes: DataFrame, keys: Sequence[str], seq: str = SEQ, op: str = OP
) -> DataFrame:
    """One row per key: its latest change.

    A maximum combines before the shuffle, so a key with very many changes sends one row per task. Spark aggregates
    maxima of structs by sorting, so each task sorts its rows by key before it combines them.
    """
    order = change_order(changes.schema, keys, seq, op)
    odd = unordered(changes.select(*[c for c in changes.columns if c not in keys]).schema)
    carried = [F.max_by(F.struct(*odd), order).alias("_odd")] if odd else []
    latest = changes.groupBy(*keys).agg(F.max(order).alias("_c"), *carried)
    return latest.select(*[F.col(c) if c in keys else F.col(f"_odd.{c}" if c in odd else f"_c.{c}").alias(c) for c in changes.columns])


def latest_change_by_hash(
    changes: DataFrame, keys: Sequence[str], seq: str = SEQ, op: str = OP
) -> DataFrame:
    """The rows of :func:`latest_change_per_key`, for feeds with very many changes a key; with few it is the slower form.

    Seq and op make one number of fixed width, so its maximum is kept in a hash table and the raw feed is not
    sorted. The feed is read again for the rows that have their key's maximum: a join that Catalyst broadcasts while
    the keys are few. Only those rows, one a key but for ties, are settled by payload. BASELINE has both forms measured.
    """
    place = (F.col(seq).cast("decimal(19,0)") * F.lit(4).cast("decimal(1,0)") + op_rank(F.col(op)).cast("decimal(1,0)")).cast("decimal(21,0)")
    # a null seq is before all others
    placed = changes.withColumn("_place", F.coalesce(place, (F.lit("-99999999999999999999").cast("decimal(20,0)") + op_rank(F.col(op)).cast("decimal(1,0)")).cast("decimal(21,0)")))
    best = placed.groupBy(*keys).agg(F.max("_place").alias("_best"))
    best, on = same_keys(placed, best, keys)
    top = placed.join(best, on & (placed["_place"] == best["_best"]), "left_semi").select(*changes.columns)
    return latest_change_per_key(top, keys, seq, op)


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the remaining columns."""
    rest = [c for c in df.columns if c not in {*keys, *order}]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def merge_state(
    state: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = SEQ, op: str = OP
) -> DataFrame:
    """State after more changes, tombstones kept; a change older than the state's row loses."""
    return latest_change_per_key(state.unionByName(changes), keys, seq, op)


def live_rows(state: DataFrame, seq: str = SEQ, op: str = OP) -> DataFrame:
    """The table a state stands for: no tombstones, no envelope."""
    return state.where(F.col(op) != DELETE).drop(seq, op)


def as_state(snapshot: DataFrame, snapshot_seq: int = -1, seq: str = SEQ, op: str = OP) -> DataFrame:
    """Snapshot rows in the shape of changes: op ``r`` at the seq the snapshot was taken."""
    return snapshot.withColumns({op: F.lit(READ), seq: F.lit(snapshot_seq).cast("bigint")})


def snapshot_then_changes(
    snapshot: DataFrame, changes: DataFrame, snapshot_seq: int, seq: str = SEQ, op: str = OP
) -> DataFrame:
    """The snapshot as ``r`` rows followed by the changes made after it."""
    later = changes.where(F.col(seq) > snapshot_seq)
    return as_state(snapshot, snapshot_seq, seq, op).unionByName(later)


def apply_changes(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = SEQ, op: str = OP
) -> DataFrame:
    """Inserts, updates and deletes in one pass over a base that carries no seq.

    Keys touched by the feed leave the base by an anti join and come back as their latest change.
    The base is only shuffled when the keys are too many for Catalyst to broadcast.
    """
    latest = latest_change_per_key(changes, keys, seq, op)
    untouched = _key_join(base, changes.select(*keys).distinct(), keys, "left_anti")
    return untouched.unionByName(live_rows(latest, seq, op).select(*base.columns))


def apply_inserts(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base plus the feed's live rows whose key is new."""
    latest = live_rows(latest_change_per_key(changes, keys))
    new = _key_join(latest, base.select(*keys), keys, "left_anti")
    return base.unionByName(new.select(*base.columns))


def apply_updates(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base with the feed's live values in the rows whose key exists; nothing is added or removed."""
    latest = live_rows(latest_change_per_key(changes, keys)).withColumn("_hit", F.lit(True))
    payload = [c for c in base.columns if c not in keys]
    renamed = latest.select(*keys, "_hit", *[F.col(c).alias(f"_new_{c}") for c in payload])
    joined = _key_join(base, renamed, keys, "left")
    taken = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in payload]
    return joined.select(*keys, *taken).select(*base.columns)


def apply_deletes(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base without the keys whose latest change is a delete."""
    latest = latest_change_per_key(changes.select(*keys, SEQ, OP), keys)
    gone = latest.where(F.col(OP) == DELETE).select(*keys)
    return _key_join(base, gone, keys, "left_anti")


def without_keys(base: DataFrame, keys_gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti join of a base with a frame of keys."""
    return _key_join(base, keys_gone.select(*keys), keys, "left_anti")


def with_computed(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Derived columns added after load, each by its SQL formula."""
    return df.withColumns({name: F.expr(formula) for name, formula in formulas.items()})


def reconcile_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of source and target per table; a table missing on one side counts 0."""

    def counts(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
        parts = [t.groupBy().agg(F.count("*").alias(name)).withColumn("table_name", F.lit(n)) for n, t in tables.items()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    both = counts(source, "source_rows").join(counts(target, "target_rows"), "table_name", "full_outer")
    rows = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("source_rows", "target_rows")}
    both = both.withColumns(rows)
    return both.select(
        "table_name",
        "source_rows",
        "target_rows",
        (F.col("target_rows") - F.col("source_rows")).alias("difference"),
        (F.col("target_rows") == F.col("source_rows")).alias("matches"),
    )


def reconcile_tree(source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = 14) -> DataFrame:
    """What :func:`reconcile_rows` finds, reading rows only where digests differ.

    Rows are dealt to 2^``bits`` ranges of their key's hash. Of each range both sides have a count and sums of row hashes,
    combined before the shuffle, so equal ranges cost a few numbers however many rows they hold. Keys and digests are
    compared under differing ranges alone, and not at all when there are none. The ranges that differ are at
    most 2^``bits``, so they are broadcast.
    """
    names = source.columns

    def placed(df: DataFrame) -> DataFrame:
        key = row_text([F.col(k) for k in keys], [df.schema[k].dataType for k in keys])
        return df.select(*names, F.shiftrightunsigned(F.xxhash64(key), 64 - bits).alias("_range"))

    def digests(df: DataFrame) -> DataFrame:
        text = row_text([F.col(c) for c in names], [df.schema[c].dataType for c in names])
        hashed = placed(df).withColumn("_text", text).select("_range", F.xxhash64("_text").alias("_a"), F.xxhash64(F.lit("b"), "_text").alias("_b"))
        # halves of 32 bits: their sums stay within 64 for 2^31 rows of a range
        halves = [h for c in ("_a", "_b") for h in (F.shiftrightunsigned(c, 32), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))]
        return hashed.groupBy("_range").agg(F.struct(F.count(F.lit(1)), *[F.sum(h) for h in halves]).alias("_digest"))

    right = digests(target).withColumnsRenamed({"_range": "_right", "_digest": "_other"})
    left = digests(source)
    both = left.join(right, left["_range"] == right["_right"], "full_outer")
    differing = pinned(both.where(~F.col("_digest").eqNullSafe(F.col("_other"))).select(F.coalesce("_range", "_right").alias("_range")))
    if differing.isEmpty():
        return reconcile_rows(source.limit(0), target.limit(0), keys)

    def under(df: DataFrame) -> DataFrame:
        return placed(df).join(F.broadcast(differing), "_range", "left_semi").drop("_range")

    return reconcile_rows(under(source), under(target), keys)


def reconcile_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows are ``missing`` in the target, ``extra`` in it, or ``different``.

    Only key and digest travel through the shuffle, however wide the rows are.
    """
    payload = [c for c in source.columns if c not in keys]

    def digested(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.unhex(digest_of(df, payload) if payload else F.sha2(F.lit(""), 256)).alias(name))

    left = digested(source, "_s")
    right, on = same_keys(left, digested(target, "_t"), keys)
    both = left.join(right, on, "full_outer")
    both = both.select(*[F.when(F.col("_s").isNotNull(), F.col(k)).otherwise(F.col(f"_key_{k}")).alias(k) for k in keys], "_s", "_t")
    status = (
        F.when(F.col("_t").isNull(), "missing")
        .when(F.col("_s").isNull(), "extra")
        .when(F.col("_s") != F.col("_t"), "different")
    )
    return both.select(*keys, status.alias("status")).where(F.col("status").isNotNull())
