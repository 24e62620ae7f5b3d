"""Read and write activity per entity: rollups, tiers, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.measures import (
    HIGH_WRITES,
    LOW_WRITES,
    OPERATIONS_PER_ROW,
    PAGE_KB,
    TIERS,
    latest_of,
    lock_weighted_io,
    or_zero,
    read_write_ratio,
    tier,
)

READS, WRITES, TOTAL = "total_reads", "total_updates", "total_io"
ROWS, LAST, CATEGORY = "row_count", "last_activity", "category"


def _sum(*columns: str) -> Column:
    out = F.col(columns[0])
    for c in columns[1:]:
        out = out + F.col(c)
    return F.sum(out).cast("bigint")


def activity_rollup(usage: DataFrame, entity: str) -> DataFrame:
    """Reads, writes, their total and the last of each kind, per entity.

    ``usage`` has user_seeks, user_scans, user_lookups, user_updates, last_user_seek,
    last_user_scan and last_user_update, any number of rows per entity.
    """
    reads = ("user_seeks", "user_scans", "user_lookups")
    return usage.groupBy(entity).agg(
        _sum(*reads).alias(READS),
        _sum("user_updates").alias(WRITES),
        _sum(*reads, "user_updates").alias(TOTAL),
        F.max("last_user_seek").alias("last_seek"),
        F.max("last_user_scan").alias("last_scan"),
        F.max("last_user_update").alias("last_update"),
    )


def operational_rollup(operational: DataFrame, entity: str) -> DataFrame:
    """Reads, writes and locks per entity from operational counters of its base (index 0 or 1)."""
    base = operational.where(F.col("index_id").isin(0, 1))
    return base.groupBy(entity).agg(
        _sum("range_scan_count", "singleton_lookup_count").alias(READS),
        _sum("leaf_insert_count", "leaf_update_count", "leaf_delete_count").alias(WRITES),
        _sum("row_lock_count", "page_lock_count").alias("locks"),
    )


def storage_rollup(partition_stats: DataFrame, entity: str) -> DataFrame:
    """Rows and space per entity over the partitions of its base."""
    base = partition_stats.where(F.col("index_id").isin(0, 1))
    return base.groupBy(entity).agg(
        _sum("row_count").alias(ROWS),
        (_sum("used_page_count") * PAGE_KB).alias("used_kb"),
        (_sum("reserved_page_count") * PAGE_KB).alias("reserved_kb"),
    )


def with_lock_weight(rolled: DataFrame) -> DataFrame:
    """Total operations where ten locks weigh as one."""
    return rolled.withColumn(TOTAL, lock_weighted_io(F.col(READS), F.col(WRITES), F.col("locks")))


def three_way_stats(
    operational: DataFrame, partition_stats: DataFrame, entities: DataFrame, entity: str
) -> DataFrame:
    """Operational and storage counters of known entities.

    Both sides are summed per entity before they meet, so partitions never multiply each other.
    """
    rolled = with_lock_weight(operational_rollup(operational, entity))
    return (
        rolled.join(storage_rollup(partition_stats, entity), entity)
        .join(entities.select(entity), entity)
    )


def row_counts(partitions: DataFrame, entity: str) -> DataFrame:
    """Rows per entity over the partitions of its base."""
    base = partitions.where(F.col("index_id").isin(0, 1))
    return base.groupBy(entity).agg(_sum("rows").alias(ROWS))


def row_counts_of_all(entities: DataFrame, partitions: DataFrame, entity: str) -> DataFrame:
    """Rows of every entity; the filter belongs to the join, so entities without a base stay (null)."""
    return entities.select(entity).join(row_counts(partitions, entity), entity, "left")


def with_ratio_and_tier(df: DataFrame, high: int = HIGH_WRITES, low: int = LOW_WRITES, metric: str = WRITES) -> DataFrame:
    """Read/write ratio, and tier by ``metric`` (writes unless told otherwise)."""
    return df.withColumns(
        {
            "read_write_ratio": read_write_ratio(F.col(READS), F.col(WRITES)),
            CATEGORY: tier(F.col(metric), high, low),
        }
    )


def full_coverage(
    entities: DataFrame,
    rolled: DataFrame,
    entity: str,
    counts: DataFrame | None = None,
    high: int = HIGH_WRITES,
    low: int = LOW_WRITES,
) -> DataFrame:
    """Every entity with its activity: zeros and tier ``low`` where there is none."""
    times = [c for c in ("last_seek", "last_scan", "last_update") if c in rolled.columns]
    activity = rolled.withColumn(LAST, latest_of(*[F.col(c) for c in times])).drop(*times) if len(times) > 1 else rolled
    out = entities.select(entity).join(activity.withColumn("_seen", F.lit(True)), entity, "left")
    if counts is not None:
        out = out.join(counts.select(entity, ROWS), entity, "left")
    zeroed = [c for c in (READS, WRITES, TOTAL, ROWS) if c in out.columns]
    out = out.withColumns({c: or_zero(F.col(c)) for c in zeroed})
    out = with_ratio_and_tier(out, high, low)
    return out.withColumn(CATEGORY, F.when(F.col("_seen"), F.col(CATEGORY)).otherwise("low")).drop("_seen")


def estimate_from_rows(counts: DataFrame, high: int = HIGH_WRITES, low: int = LOW_WRITES) -> DataFrame:
    """Activity guessed from row counts alone: all reads, and the tier from the guess."""
    guess = or_zero(F.col(ROWS)) * OPERATIONS_PER_ROW
    return counts.withColumns(
        {
            ROWS: or_zero(F.col(ROWS)),
            TOTAL: guess,
            READS: guess,
            WRITES: F.lit(0).cast("bigint"),
            "read_write_ratio": F.lit(0.0),
            CATEGORY: tier(guess, high, low),
        }
    )


def fallback_chain(
    entities: DataFrame,
    usage: DataFrame,
    operational: DataFrame,
    counts: DataFrame,
    entity: str,
    high: int = HIGH_WRITES,
    low: int = LOW_WRITES,
) -> DataFrame:
    """The best statistic known per entity: usage, else operational, else rows, else nothing.

    All three inputs hold one row per entity. ``stat_source`` names the one taken.
    """
    measures = (READS, WRITES, TOTAL)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(entity, F.struct(*measures).alias(name))

    out = (
        entities.select(entity)
        .join(side(usage, "usage"), entity, "left")
        .join(side(operational, "operational"), entity, "left")
        .join(counts.select(entity, ROWS), entity, "left")
    )
    guess = F.col(ROWS) * OPERATIONS_PER_ROW
    estimate = F.when(
        F.col(ROWS).isNotNull(),
        F.struct(guess.alias(READS), F.lit(0).cast("bigint").alias(WRITES), guess.alias(TOTAL)),
    )
    taken = F.coalesce("usage", "operational", estimate)
    source = (
        F.when(F.col("usage").isNotNull(), "usage")
        .when(F.col("operational").isNotNull(), "operational")
        .when(F.col(ROWS).isNotNull(), "rows")
        .otherwise("none")
    )
    out = out.select(
        entity,
        source.alias("stat_source"),
        or_zero(F.col(ROWS)).alias(ROWS),
        *[or_zero(taken.getField(m)).alias(m) for m in measures],
    )
    guessed = F.col("stat_source") == "rows"
    return out.withColumns(
        {
            "read_write_ratio": F.when(guessed, 0.0).otherwise(read_write_ratio(F.col(READS), F.col(WRITES))),
            CATEGORY: tier(F.when(guessed, F.col(TOTAL)).otherwise(F.col(WRITES)), high, low),
        }
    )


def tier_summary(activity: DataFrame) -> DataFrame:
    """Entities in total and per tier; a tier without entities shows 0."""
    counted = activity.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(CATEGORY) == t).alias(t) for t in TIERS]
    )
    rows = [F.struct(F.lit(t).alias("tier"), F.col(t).alias("n_entities")) for t in ("total", *TIERS)]
    return counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def global_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def rank_order(metric: str = TOTAL, tie: str = "entity") -> list[Column]:
    """Busiest first, ties by name."""
    return [F.desc(metric), F.asc(tie)]


def top_hot(activity: DataFrame, k: int, entity: str, metric: str = WRITES) -> DataFrame:
    """The ``k`` busiest entities."""
    return activity.orderBy(*rank_order(metric, entity)).limit(k)


def activity_report(
    activity: DataFrame,
    entity: str,
    high: int = HIGH_WRITES,
    low: int = LOW_WRITES,
    jobs: DataFrame | None = None,
) -> DataFrame:
    """The report as rows: thresholds, summary counts, then one nested ``entry`` per entity.

    Entities number as many as the data holds, so they stay rows instead of one list. ``jobs``
    (entity, job_name) adds the job of each entity, and a ``config`` row per job with its number of entities.
    """
    detail = activity if jobs is None else activity.join(jobs.select(entity, "job_name"), entity, "left")
    fields = [c for c in detail.columns if c != entity]
    entry = F.struct(*fields)
    tables = detail.select(
        F.lit("table").alias("section"),
        F.col(entity).cast("string").alias("name"),
        F.lit(None).cast("bigint").alias("value"),
        entry.alias("entry"),
    )
    summary = tier_summary(activity).select(
        F.lit("summary").alias("section"), F.col("tier").alias("name"), F.col("n_entities").alias("value")
    )
    limits = activity.sparkSession.createDataFrame(
        [("threshold", "high", high), ("threshold", "low", low)], "section string, name string, value bigint"
    )
    out = tables.unionByName(summary, allowMissingColumns=True).unionByName(limits, allowMissingColumns=True)
    if jobs is None:
        return out
    configs = detail.where(F.col("job_name").isNotNull()).groupBy(F.col("job_name").alias("name")).agg(F.count("*").alias("value"))
    return out.unionByName(configs.withColumn("section", F.lit("config")), allowMissingColumns=True)


def totals_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Members, operations, writes and rows summed per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_tables"),
        _sum(TOTAL).alias("estimated_io_ops"),
        _sum(WRITES).alias("estimated_update_ops"),
        _sum(ROWS).alias("total_rows"),
    )
