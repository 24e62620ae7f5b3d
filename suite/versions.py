"""Histories, retention, gaps and health (survey group F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.operators import versions as ver
from suite.registry import query, table


@query(
    """with e as (select user_id, event_id, event_type, cast(value as varchar) as value,
      lag(event_type) over w as ot, cast(lag(value) over w as varchar) as ov, lag(event_id) over w is not null as has
      from (select user_id, event_id, event_type, cast(value as decimal(19,4)) as value from events)
      window w as (partition by user_id order by event_id))
    select user_id, event_id, 'event_type' as attribute, ot as old_value, event_type as new_value from e where has and ot is distinct from event_type
    union all select user_id, event_id, 'value', ov, value from e where has and ov is distinct from value"""
)
def version_history(spark, sf):
    rows = table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(19,4)"))
    return ver.version_history(rows, ["user_id"], "event_id", ["event_type", "value"], partitions=8)


YOUNG, SINCE = "2024-01-13 00:00:00", "2024-01-01 00:00:00"


@query(
    f"""select user_id, event_id, ts, n <= 3 as by_count, ts >= timestamp '{YOUNG}' as by_age, ts >= timestamp '{SINCE}' and m = 1 as by_month
    from (select user_id, event_id, ts, row_number() over (partition by user_id order by event_id desc) as n,
      row_number() over (partition by user_id, date_trunc('month', ts) order by event_id) as m from events)
    where n <= 3 or ts >= timestamp '{YOUNG}' or (ts >= timestamp '{SINCE}' and m = 1)"""
)
def retain_versions(spark, sf):
    rows = table(spark, sf, "events")
    return ver.retain_versions(rows, "user_id", "event_id", "ts", 3, YOUNG, SINCE)


@query(
    """select user_id, gap_start, ts as gap_end from (select user_id, ts, lag(ts) over (partition by user_id order by ts) as gap_start
      from events where event_type <> 'error') where ts > gap_start + interval 30 minutes"""
)
def stale_gap_alert(spark, sf):
    ok = table(spark, sf, "events").where("event_type <> 'error'")
    return ver.stale_gaps(ok, "user_id", "ts", 1800)


NOW = "2024-01-15 00:00:00"


@query(
    f"""select user_id, cast(count(*) as bigint) as n_runs, cast(count(*) filter (event_type = 'error') as bigint) as n_failed,
      cast(count(*) filter (value * 2 > 60) as bigint) as n_slow, max(value) as max_duration,
      arg_max(v, event_id) - arg_min(v, event_id) as size_growth, max(case when event_type <> 'error' then ts end) as last_success,
      count(*) filter (event_type = 'error')::double / count(*)::double as failure_rate,
      coalesce(max(case when event_type <> 'error' then ts end) + interval 30 minutes < timestamp '{NOW}', true) as is_stale
    from (select *, length(props) * event_id as v from events) group by user_id"""
)
def progress_health(spark, sf):
    log = table(spark, sf, "events").withColumns(
        {"ok": F.col("event_type") != "error", "size": F.length("props") * F.col("event_id")}
    )
    return ver.progress_health(log, "user_id", "event_id", "ts", "ok", "value", "size", 60.0, NOW)
