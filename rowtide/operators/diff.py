"""Differences between two versions of a schema or of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.catalog import COLUMN, TABLE
from rowtide.operators.changes import CREATE, DELETE, OP, SEQ, UPDATE

ADDED, REMOVED, MODIFIED, SAME = "+", "-", "~", "="

# Attributes compared one by one: change kind and catalog column.
_COMPARED = (
    ("type", "data_type"),
    ("nullability", "is_nullable"),
    ("length", "character_maximum_length"),
    ("precision", "numeric_precision"),
    ("scale", "numeric_scale"),
    ("ordinal", "ordinal_position"),
    ("formula", "definition"),
)


def _null_word(is_nullable: Column) -> Column:
    return F.when(is_nullable == "YES", "NULL").otherwise("NOT NULL")


def _message(kind: str, name: Column, old: Column, new: Column) -> Column:
    """Report line of a change; the wording is a fixed format."""
    if kind == "added":
        return F.concat(F.lit("+ Added column: "), name, F.lit(" ("), new, F.lit(")"))
    if kind == "removed":
        return F.concat(F.lit("- Removed column: "), name)
    if kind == "nullability":
        old, new = _null_word(old), _null_word(new)
    title = {"type": "Modified column", "nullability": "Nullability changed"}.get(kind, f"Changed {kind}")
    shown = [F.coalesce(v.cast("string"), F.lit("none")) for v in (old, new)]
    return F.concat(F.lit(f"~ {title}: "), name, F.lit(" ("), shown[0], F.lit(" -> "), shown[1], F.lit(")"))


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per change of a column, over the catalogs of many tables at once.

    Columns of tables that one version lacks altogether count as added or removed; see
    :func:`rowtide.operators.catalog.new_entities` to set those tables apart.
    """
    attributes = [(k, a) for k, a in _COMPARED if a in old.columns and a in new.columns]
    names = [a for _, a in attributes]
    before = old.select(*COLUMN, F.struct(*names).alias("_o"))
    after = new.select(*COLUMN, F.struct(*names).alias("_n"))
    both = before.join(after, COLUMN, "full_outer")
    name = F.col("column_name")

    def entry(kind: str, old_value: Column, new_value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            old_value.cast("string").alias("old_value"),
            new_value.cast("string").alias("new_value"),
            _message(kind, name, old_value, new_value).alias("message"),
        )

    nothing = F.lit(None).cast("string")
    is_new, is_gone = F.col("_o").isNull(), F.col("_n").isNull()
    found = [
        F.when(is_new, entry("added", nothing, F.col("_n.data_type"))),
        F.when(is_gone, entry("removed", F.col("_o.data_type"), nothing)),
    ]
    for kind, attribute in attributes:
        o, n = F.col(f"_o.{attribute}"), F.col(f"_n.{attribute}")
        found.append(F.when(~is_new & ~is_gone & ~o.eqNullSafe(n), entry(kind, o, n)))
    changes = both.select(*COLUMN, F.explode(F.array_compact(F.array(*found))).alias("_c"))
    return changes.select(*COLUMN, "_c.*")


def key_text(keys: DataFrame) -> DataFrame:
    """Key columns of each table in order, as one text.

    ``keys`` holds distinct key columns; source systems allow a few dozen at most per table.
    """
    ordered = F.sort_array(F.collect_list(F.struct("key_position", "column_name")))
    return keys.groupBy(*TABLE).agg(F.array_join(F.transform(ordered, lambda k: k["column_name"]), ",").alias("key"))


def key_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tables present in both versions whose ordered key differs."""
    before, after = key_text(old), key_text(new)
    both = before.withColumnRenamed("key", "old_key").join(after.withColumnRenamed("key", "new_key"), TABLE, "full_outer")
    both = both.withColumns({c: F.coalesce(c, F.lit("")) for c in ("old_key", "new_key")})
    message = F.concat(
        F.lit("~ Primary key changed: ["), "old_key", F.lit("] -> ["), "new_key", F.lit("]")
    )
    return both.where(F.col("old_key") != F.col("new_key")).withColumn("message", message)


def change_summary(changes: DataFrame, by: Sequence[str] = TABLE, kind: str = "kind") -> DataFrame:
    """Number of changes of each kind."""
    return changes.groupBy(*by, kind).agg(F.count("*").alias("n_changes"))


def match_sides(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key of either version with ``+`` (new only), ``-`` (old only) or ``=`` (both)."""
    before = old.select(*keys, F.lit(True).alias("_o"))
    after = new.select(*keys, F.lit(True).alias("_n"))
    both = before.join(after, list(keys), "full_outer")
    side = F.when(F.col("_o").isNull(), ADDED).when(F.col("_n").isNull(), REMOVED).otherwise(SAME)
    return both.select(*keys, side.alias("side"))


def paired_versions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both versions of every key side by side, with the kind of its change."""
    payload = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*payload).alias("_old"))
    after = new.select(*keys, F.struct(*payload).alias("_new"))
    both = before.join(after, list(keys), "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), ADDED)
        .when(F.col("_new").isNull(), REMOVED)
        .when(F.col("_old").eqNullSafe(F.col("_new")), SAME)
        .otherwise(MODIFIED)
    )
    return both.withColumn("kind", kind)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with ``+``, ``-``, ``~`` or ``=``; rows are compared null-safe, column by column."""
    return paired_versions(old, new, keys).select(*keys, "kind")


def column_level_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed columns of modified rows with old and new value as text."""
    payload = [c for c in new.columns if c not in keys]
    pairs = paired_versions(old, new, keys).where(F.col("kind") == MODIFIED)

    def entry(c: str) -> Column:
        o, n = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        value = F.struct(
            F.lit(c).alias("column_name"),
            o.cast("string").alias("old_value"),
            n.cast("string").alias("new_value"),
        )
        return F.when(~o.eqNullSafe(n), value)

    found = F.explode(F.array_compact(F.array(*[entry(c) for c in payload])))
    return pairs.select(*keys, found.alias("_c")).select(*keys, "_c.*")


def diff_to_change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: int) -> DataFrame:
    """Changes that turn the old version into the new one, all at one ``seq``."""
    payload = [c for c in new.columns if c not in keys]
    pairs = paired_versions(old, new, keys).where(F.col("kind") != SAME)
    op = F.when(F.col("kind") == ADDED, CREATE).when(F.col("kind") == REMOVED, DELETE).otherwise(UPDATE)
    row = F.coalesce("_new", "_old")
    return pairs.select(
        *keys,
        *[row.getField(c).alias(c) for c in payload],
        op.alias(OP),
        F.lit(seq).cast("bigint").alias(SEQ),
    )


def keys_added(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only the new version holds."""
    return new.select(*keys).subtract(old.select(*keys))


def keys_removed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only the old version holds."""
    return keys_added(new, old, keys)


def keys_common(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys both versions hold."""
    return old.select(*keys).intersect(new.select(*keys))
