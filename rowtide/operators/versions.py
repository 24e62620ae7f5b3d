"""Histories: value changes over versions, retention, gaps and health of progress logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.times import seconds_interval, wall_seconds
from rowtide.operators.ranking import RANGE, Ranges
from rowtide.session import pinned

def version_history(
    df: DataFrame, keys: Sequence[str], seq: str, attributes: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Old and new value of each attribute whenever it changes from one version to the next.

    ``seq`` orders the versions of a key and is unique in it; a null key is a key. Rows are dealt by ranges of
    key and seq, cut by rank wherever the data lie, so a key of any length and spread of seq takes as many
    ranges as its rows need. Of keys that cross a bound the last version of each range is handed to
    the next one: a few rows per range. Only keys and seq are stored; ``df`` is read again for the rows.
    """
    named = df.select(*keys, seq, F.struct(*attributes).alias("_now"))
    ranges = Ranges(named, keys, [seq], partitions)
    rows = named.withColumn(RANGE, ranges.number)
    tails = ranges.of_shared_groups(rows).groupBy(RANGE, *keys).agg(F.max_by("_now", F.struct(seq)).alias("_tail"))
    carry = F.lag("_tail").over(Window.partitionBy(*keys).orderBy(RANGE)).alias("_carry")
    carried = pinned(tails.select(RANGE, *keys, carry)).where(F.col("_carry").isNotNull())
    rows = rows.withColumn("_prev", F.lag("_now").over(Window.partitionBy(RANGE, *keys).orderBy(seq)))
    rows = ranges.with_shared(rows, carried)
    before = F.coalesce("_prev", "_carry")

    def entry(c: str):
        o, n = before.getField(c), F.col("_now").getField(c)
        change = F.struct(
            F.lit(c).alias("attribute"),
            o.cast("string").alias("old_value"),
            n.cast("string").alias("new_value"),
        )
        return F.when(before.isNotNull() & ~o.eqNullSafe(n), change)

    found = F.explode(F.array_compact(F.array(*[entry(c) for c in attributes])))
    return rows.select(*keys, seq, found.alias("_c")).select(*keys, seq, "_c.*")


def retain_versions(
    versions: DataFrame,
    entity: str,
    version: str,
    ts: str,
    last_n: int,
    younger_than: str,
    monthly_since: str,
) -> DataFrame:
    """Versions to keep per entity, each with the rules that keep it.

    Kept are the last ``last_n``, all at or after ``younger_than``, and the first of each month from
    ``monthly_since`` on. The top-n filter is applied within each task before the shuffle, the
    monthly one is an aggregate, so a busy entity is never sorted whole.
    """
    ids = versions.select(entity, version, ts)
    newest = Window.partitionBy(entity).orderBy(F.desc(version))
    last = ids.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= last_n).drop("_rn")
    young = ids.where(F.col(ts) >= F.lit(younger_than).cast("timestamp_ntz"))
    month = F.substring(F.col(ts).cast("string"), 1, 7)
    monthly = (
        ids.where(F.col(ts) >= F.lit(monthly_since).cast("timestamp_ntz"))
        .groupBy(entity, month.alias("_month"))
        .agg(F.min(F.struct(version, ts)).alias("_v"))
        .select(entity, f"_v.{version}", f"_v.{ts}")
    )
    rules = {"by_count": last, "by_age": young, "by_month": monthly}
    tagged = None
    for name in rules:
        part = rules[name].withColumns({r: F.lit(r == name) for r in rules})
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(entity, version, ts).agg(*[F.max(r).alias(r) for r in rules])


def stale_gaps(events: DataFrame, entity: str, ts: str, limit_seconds: int) -> DataFrame:
    """Stretches longer than the limit without an event of an entity.

    Two events in one slot of ``limit_seconds`` are never that far apart, so first and last event
    per slot are enough: they are aggregated before anything is sorted.
    """
    at = wall_seconds(F.col(ts))
    slot = F.call_function("div", at - F.pmod(at, F.lit(limit_seconds)), F.lit(limit_seconds)).alias("_slot")  # rounds down, before 1970 too
    slots = events.groupBy(entity, slot).agg(F.min(ts).alias("gap_end"), F.max(ts).alias("_last"))
    previous = F.lag("_last").over(Window.partitionBy(entity).orderBy("_slot"))
    gaps = slots.withColumn("gap_start", previous).where(F.col("gap_start").isNotNull())
    return gaps.where(
        F.col("gap_end") > F.col("gap_start") + seconds_interval(limit_seconds)
    ).select(entity, "gap_start", "gap_end")


def progress_health(
    log: DataFrame,
    entity: str,
    seq: str,
    ts: str,
    ok: str,
    duration: str,
    size: str,
    interval: float,
    now: str,
    stale_seconds: int = 1800,
) -> DataFrame:
    """Health of each entity's progress log.

    Share of runs that took over half the ``interval``, failure rate, growth of ``size`` from first
    to last run, and the time since the last success with an alert when it exceeds the limit.
    """
    first = F.min(F.struct(seq, size)).getField(size)
    last = F.max(F.struct(seq, size)).getField(size)
    last_ok = F.max(F.when(F.col(ok), F.col(ts)))
    rolled = log.groupBy(entity).agg(
        F.count("*").alias("n_runs"),
        F.count_if(~F.col(ok)).alias("n_failed"),
        F.count_if(F.col(duration) * 2 > interval).alias("n_slow"),
        F.max(duration).alias("max_duration"),
        (last - first).alias("size_growth"),
        last_ok.alias("last_success"),
    )
    at = F.lit(now).cast("timestamp_ntz")
    limit = seconds_interval(stale_seconds)
    return rolled.withColumns(
        {
            "failure_rate": F.col("n_failed") / F.col("n_runs"),
            "is_stale": F.coalesce(F.col("last_success") + limit < at, F.lit(True)),
        }
    )
