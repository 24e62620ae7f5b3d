"""Operators over catalog frames: tables, columns, constraints, keys and their types.

A table is named by ``table_schema`` and ``table_name``. A key frame has one row per table and key
column; a table has few key columns, so windows over one table's key stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.digests import additive_digest, row_digest
from rowtide.functions.typemap import FALLBACK_TYPE, rendered_type, stored_length, type_map_frame
from rowtide.operators.selection import select_names, where_equal, without_system_names
from rowtide.session import spread

TABLE = ["table_schema", "table_name"]
COLUMN = [*TABLE, "column_name"]
UNKNOWN_POSITION = 999
FALLBACK_KEY = "id"


def discover_tables(
    tables: DataFrame,
    schema: str | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> DataFrame:
    """User tables of a schema that pass the patterns."""
    bound = {"table_type": "BASE TABLE"} | ({"table_schema": schema} if schema else {})
    user = without_system_names(where_equal(tables, bound), "table_name")
    return select_names(user, "table_name", include, exclude, mode)


def join_physical(columns: DataFrame, physical: DataFrame) -> DataFrame:
    """Declared columns with their physical entry, matched on table and column name."""
    return columns.join(physical, COLUMN, "inner")


def join_definitions(columns: DataFrame, computed: DataFrame) -> DataFrame:
    """Columns with the formula of those that are computed; the others keep null."""
    return columns.join(computed, [*TABLE, "column_id"], "left")


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Columns of primary-key constraints, matched on schema and name: names repeat over schemas."""
    named = constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    return named.join(usage.select("table_schema", "constraint_name", "column_name"), ["table_schema", "constraint_name"])


def key_by_position(keys: DataFrame, columns: DataFrame, by: Sequence[str] = COLUMN) -> DataFrame:
    """Key columns numbered by their position in the table; columns not selected come last.

    Rows meet in tasks whose number grows with the input, so no task's share to sort does. ``by`` is ``COLUMN`` or, with a
    shuffle less, ``TABLE``; see :func:`schema_checksum`.
    """
    known = columns.select(*COLUMN, "ordinal_position").dropna(subset=COLUMN)
    known = spread(known, *by).withColumn("_in_key", F.lit(False))
    named = spread(keys.select(*COLUMN), *by).distinct().withColumn("_in_key", F.lit(True))
    # a join of named with known; a window takes rows dealt out by less than all its columns as they lie, a join does not
    same = Window.partitionBy(F.xxhash64(*COLUMN), *COLUMN)  # names of a schema begin alike, and text is compared slowly
    met = known.unionByName(named, allowMissingColumns=True)
    met = met.withColumns({"_any": F.max("_in_key").over(same), "_only": F.min("_in_key").over(same)})
    placed = met.where(F.when(F.col("_in_key"), F.col("_only")).otherwise(F.col("_any"))).select(*COLUMN, "ordinal_position")
    placed = spread(placed.withColumn("ordinal_position", F.coalesce("ordinal_position", F.lit(UNKNOWN_POSITION))), *TABLE)
    order = Window.partitionBy(F.xxhash64(*TABLE), *TABLE).orderBy("ordinal_position", "column_name")
    return placed.withColumn("key_position", F.row_number().over(order))


def first_key_column(keys: DataFrame, columns: DataFrame) -> DataFrame:
    """The column a snapshot is split on: the first of each key."""
    known = columns.select(*COLUMN, "ordinal_position")
    placed = keys.select(*COLUMN).join(known, COLUMN, "left")
    first = F.struct(F.coalesce("ordinal_position", F.lit(UNKNOWN_POSITION)), F.col("column_name").alias("name"))
    return placed.groupBy(*TABLE).agg(F.min(first).getField("name").alias("chunk_column"))


def fallback_key(tables: DataFrame, keys: DataFrame, columns: DataFrame) -> DataFrame:
    """Key columns per table: declared, else the first column, else ``id``.

    A fallback may not be unique; check it with :func:`rowtide.operators.quality.key_quality`.
    """
    declared = keys.select(*COLUMN).withColumn("key_source", F.lit("declared"))
    bare = tables.select(*TABLE).join(keys.select(*TABLE).distinct(), TABLE, "left_anti")
    first = columns.groupBy(*TABLE).agg(
        F.min(F.struct("ordinal_position", "column_name")).getField("column_name").alias("_first")
    )
    guessed = bare.join(first, TABLE, "left").select(
        *TABLE,
        F.coalesce("_first", F.lit(FALLBACK_KEY)).alias("column_name"),
        F.when(F.col("_first").isNull(), "default").otherwise("first_column").alias("key_source"),
    )
    return declared.unionByName(guessed)


def map_types(
    columns: DataFrame,
    custom: Sequence[tuple[str, str, str]] = (),
    custom_wins: bool = True,
    per_column: DataFrame | None = None,
) -> DataFrame:
    """Columns with their stream and target type; an unmapped type becomes ``STRING``.

    ``per_column`` (table, column, ``custom_type``) goes before any mapping. The map has a fixed
    number of rows, so it is broadcast.
    """
    types = type_map_frame(columns.sparkSession, custom, custom_wins).drop("priority")
    mapped = columns.withColumn("source_type", F.lower("data_type")).join(F.broadcast(types), "source_type", "left")
    length = stored_length(F.col("character_maximum_length"))

    def rendered(name: str):
        template = F.coalesce(F.col(name), F.lit(FALLBACK_TYPE))
        return rendered_type(template, length, F.col("numeric_precision"), F.col("numeric_scale"))

    mapped = mapped.withColumn("is_mapped", F.col("target_type").isNotNull())
    mapped = mapped.withColumns({name: rendered(name) for name in ("stream_type", "target_type")})
    if per_column is not None:
        mapped = mapped.join(per_column.select(*COLUMN, "custom_type"), COLUMN, "left")
        mapped = mapped.withColumns(
            {name: F.coalesce("custom_type", name) for name in ("stream_type", "target_type")}
        ).drop("custom_type")
    return mapped


def type_usage(columns: DataFrame, custom: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Columns per source type, with types the map does not know flagged."""
    used = columns.groupBy(F.lower("data_type").alias("source_type")).agg(F.count("*").alias("n_columns"))
    types = type_map_frame(columns.sparkSession, custom).select("source_type", "target_type")
    joined = used.join(F.broadcast(types), "source_type", "left")
    return joined.select(
        "source_type",
        "n_columns",
        F.coalesce("target_type", F.lit(FALLBACK_TYPE)).alias("target_type"),
        F.col("target_type").isNotNull().alias("is_mapped"),
    )


def derived_by_table(derived: DataFrame) -> DataFrame:
    """Derived columns per table and job, with the table's number of columns and of jobs.

    ``derived`` has a row per table, column and job. Jobs stay rows, so no list grows with the data.
    """
    per_job = derived.groupBy(*TABLE, "job").agg(F.count("*").alias("job_columns"))
    per_table = per_job.groupBy(*TABLE).agg(
        F.sum("job_columns").alias("table_columns"), F.count("*").alias("table_jobs")
    )
    return per_job.join(per_table, TABLE)


def new_entities(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows present now whose key the previous snapshot does not hold."""
    return current.join(previous.select(*keys), list(keys), "left_anti")


_ATTRIBUTES = (
    "column_name",
    "data_type",
    "ordinal_position",
    "is_nullable",
    "character_maximum_length",
    "numeric_precision",
    "numeric_scale",
    "definition",
)


def schema_checksum(columns: DataFrame, keys: DataFrame, by: Sequence[str] = COLUMN) -> DataFrame:
    """SHA-256 per table over all column attributes and the key with its order.

    Each column is hashed with its position and the hashes are added up, so a table is never
    gathered in one place however many columns a catalog lists for it. They are combined in tasks whose
    number grows with the input, as a task keeps a sum for each table it meets.

    ``by`` says what rows are dealt out by. By ``COLUMN`` a table of any width spreads over the tasks, but sums of nearly every
    column are shuffled once more. By ``TABLE`` one task streams over all columns of a table and keeps its sums alone, so
    only plain rows are shuffled, and none where they lie by table already: for catalogs of many tables.
    """
    described = columns.select(*TABLE, F.lit("column").alias("_kind"), *[a for a in _ATTRIBUTES if a in columns.columns])
    keyed = keys.select(*TABLE, F.lit("key").alias("_kind"), "column_name", F.col("key_position").alias("ordinal_position"))
    rows = spread(described.unionByName(keyed, allowMissingColumns=True), *by)
    fields = [F.col(c) for c in rows.columns if c not in TABLE]
    digest = additive_digest(row_digest(fields))
    return rows.groupBy(*TABLE).agg(F.sha2(digest, 256).alias("checksum"))


def changed_tables(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tables whose checksum differs between two catalog versions."""
    before = old.withColumnRenamed("checksum", "old_checksum")
    after = new.withColumnRenamed("checksum", "new_checksum")
    return before.join(after, TABLE).where(F.col("old_checksum") != F.col("new_checksum"))
