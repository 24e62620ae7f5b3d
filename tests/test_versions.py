"""Histories and gaps against brute force, with one key holding most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowtide.operators import versions as ver

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(3)
    data, at = [], START
    for seq in range(2000):
        at += timedelta(seconds=rng.choice([1, 30, 400, 1000, 2500]))
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        data.append((key, seq, at, rng.choice(["x", "y", None]), rng.randrange(3)))
    return data, spark.createDataFrame(data, "k string, seq bigint, ts timestamp_ntz, v string, n int")


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_history(spark, log, partitions):
    data, df = log
    expected, last = set(), {}
    for key, seq, _, v, n in data:
        if key in last:
            for name, old, new in (("v", last[key][0], v), ("n", last[key][1], n)):
                if old != new:
                    expected.add((key, seq, name, None if old is None else str(old), None if new is None else str(new)))
        last[key] = (v, n)
    got = [tuple(r) for r in ver.version_history(df, ["k"], "seq", ["v", "n"], partitions).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_uneven_seq_null_key_and_spread(spark):
    """One old outlier far from the rest of a long key, and a null key, are cut by rank like any other."""
    data = [("hot", 0, "x")] + [("hot", 10**12 + i, "xy"[i % 2]) for i in range(3000)] + [(None, i, "xyz"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, seq bigint, v string")
    got = {(r.k, r.seq, r.old_value, r.new_value) for r in ver.version_history(df, ["k"], "seq", ["v"], 12).collect()}
    expected = {("hot", 10**12 + i, "yx"[i % 2], "xy"[i % 2]) for i in range(1, 3000)}
    expected |= {(None, i, "zxy"[i % 3], "xyz"[i % 3]) for i in range(1, 3000)}
    assert got == expected
    ranges = df.repartitionByRange(12, "k", "seq").groupBy(F.spark_partition_id(), "k").count().agg(F.max("count")).first()[0]
    assert ranges < 1500


def test_gaps_before_1970(spark):
    times = [datetime(1969, 12, 31, 23, 35), datetime(1970, 1, 1, 0, 25), datetime(1970, 1, 1, 0, 30)]
    df = spark.createDataFrame([("a", t) for t in times], "k string, ts timestamp_ntz")
    assert [(r.gap_start, r.gap_end) for r in ver.stale_gaps(df, "k", "ts", 1800).collect()] == [(times[0], times[1])]


@pytest.mark.parametrize("limit", [60, 1800, 3600])
def test_gaps(spark, log, limit):
    data, df = log
    expected, last = set(), {}
    for key, _, ts, _, _ in data:
        if key in last and ts - last[key] > timedelta(seconds=limit):
            expected.add((key, last[key], ts))
        last[key] = ts
    assert {tuple(r) for r in ver.stale_gaps(df, "k", "ts", limit).collect()} == expected


def test_gap_of_exactly_the_limit_is_none(spark):
    df = spark.createDataFrame([("a", START), ("a", START + timedelta(seconds=60)), ("a", START + timedelta(seconds=120, microseconds=1))], "k string, ts timestamp_ntz")
    assert [r.gap_end for r in ver.stale_gaps(df, "k", "ts", 60).collect()] == [START + timedelta(seconds=120, microseconds=1)]


def test_retention(spark, log):
    data, df = log
    young, since = data[-50][2], START
    expected = set()
    for key in {r[0] for r in data}:
        mine = [r for r in data if r[0] == key]
        expected |= {(key, r[1]) for r in mine[-3:]} | {(key, r[1]) for r in mine if r[2] >= young}
        months = {}
        for r in mine:
            months.setdefault((r[2].year, r[2].month), r)
        expected |= {(key, r[1]) for r in months.values()}
    kept = ver.retain_versions(df, "k", "seq", "ts", 3, str(young), str(since)).collect()
    assert {(r.k, r.seq) for r in kept} == expected and len(kept) == len(expected)
    assert all(r.by_count or r.by_age or r.by_month for r in kept)


def test_health(spark):
    rows = [("a", 1, START, True, 40.0, 10), ("a", 2, START + timedelta(minutes=5), False, 10.0, 30), ("b", 1, START, False, 1.0, 5)]
    df = spark.createDataFrame(rows, "k string, seq bigint, ts timestamp_ntz, ok boolean, took double, size bigint")
    got = {r.k: r for r in ver.progress_health(df, "k", "seq", "ts", "ok", "took", "size", 60.0, "2024-01-01 00:30:00").collect()}
    a, b = got["a"], got["b"]
    assert (a.n_runs, a.n_failed, a.n_slow, a.max_duration, a.size_growth, a.failure_rate, a.is_stale) == (2, 1, 1, 40.0, 20, 0.5, False)
    assert (b.last_success, b.failure_rate, b.is_stale) == (None, 1.0, True)
