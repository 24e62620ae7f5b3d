"""Wall-clock arithmetic that never passes through a session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the clock the timestamp shows."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
