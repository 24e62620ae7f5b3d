import random
from datetime import datetime, timedelta

import pytest

from rowtide.operators import changes as ch
from rowtide.session import workspace
from rowtide.sources.merge_store import KeyedTable
from rowtide.streaming import feeds, state
from tests.test_changes import BASE, FEED, FINAL, SCHEMA, base, feed


def files(spark, path, rows, each=1, seed=0):
    mixed = rows[:]
    random.Random(seed).shuffle(mixed)
    for i in range(0, len(mixed), each):
        feed(spark, mixed[i : i + each]).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def target(spark):
    t = KeyedTable(spark, workspace(spark, "t"), ["id"], base(spark, BASE).schema, buckets=2)
    t.load(base(spark, BASE))
    return t


def test_many_batches_equal_one(spark, rows, target):
    path = workspace(spark, "f")
    files(spark, path, FEED, each=3)
    stream = feeds.change_stream(spark, path, SCHEMA, max_files=1)
    feeds.run_available(feeds.stream_into(stream, target, workspace(spark, "p")))
    assert len(target.store.committed_batches()) == 4
    assert rows(target.read()) == FINAL


def test_open_deltas_stay_few(spark, rows, target):
    path = workspace(spark, "f")
    files(spark, path, FEED, each=1)
    stream = feeds.change_stream(spark, path, SCHEMA, max_files=1)
    feeds.run_available(feeds.stream_into(stream, target, workspace(spark, "p"), compact_every=2, keep=1))
    assert len(target.store.open_deltas()) < 2 and len(target.store._versions()) == 1
    assert rows(target.read()) == FINAL


def test_failed_batch_is_replayed(spark, rows, target):
    path, progress = workspace(spark, "f"), workspace(spark, "p")
    files(spark, path, FEED, each=5)
    failed = []

    class Flaky:
        def apply(self, batch, batch_id):
            target.apply(batch, batch_id)
            if batch_id == 1 and not failed:
                failed.append(batch_id)
                raise RuntimeError("lost after the write")

    stream = feeds.change_stream(spark, path, SCHEMA, max_files=1)
    with pytest.raises(Exception, match="lost after the write"):
        feeds.run_available(feeds.stream_into(stream, Flaky(), progress))
    feeds.run_available(feeds.stream_into(feeds.change_stream(spark, path, SCHEMA, max_files=1), Flaky(), progress))
    assert failed == [1]
    assert rows(target.read()) == FINAL


def test_state_lets_only_later_changes_pass(spark):
    path = workspace(spark, "f")
    for part in ([(1, "b", None, "u", 20), (2, "x", 9007199254740993 % 2**31, "c", 1)], [(1, "a", 1, "u", 10), (1, "b", None, "u", 20)], [(2, "x", 1, "d", 1), (1, "c", 2, "u", 30)]):
        feed(spark, part).coalesce(1).write.mode("append").parquet(path)
    stream = feeds.change_stream(spark, path, SCHEMA, max_files=1)
    passed = []
    state.use_rocksdb(spark)
    writer = state.latest_by_state(stream, ["id"]).writeStream.outputMode("update")
    query = writer.foreachBatch(lambda df, k: passed.append([tuple(r) for r in df.collect()]))
    feeds.run_available(query.option("checkpointLocation", workspace(spark, "p")).trigger(availableNow=True).start())
    flat = [sorted(batch, key=repr) for batch in passed if batch]
    assert flat == [
        [(1, "b", None, "u", 20), (2, "x", 1, "c", 1)],
        [(1, "c", 2, "u", 30), (2, "x", 1, "d", 1)],
    ]


def test_ties_reach_the_receiver(spark, rows):
    """Equal seq and op in different batches: both payloads pass, an exact repeat does not."""
    path = workspace(spark, "f")
    tie = [(1, "a", 9, "u", 5), (1, "a", 10, "u", 5), (1, "a", 10, "u", 5), (1, "a", 1, "u", 4)]
    for row in tie:
        feed(spark, [row]).coalesce(1).write.mode("append").parquet(path)
    passed = []
    state.use_rocksdb(spark)
    writer = state.latest_by_state(feeds.change_stream(spark, path, SCHEMA, max_files=1), ["id"]).writeStream
    query = writer.outputMode("update").foreachBatch(lambda df, k: passed.extend(tuple(r) for r in df.collect()))
    feeds.run_available(query.option("checkpointLocation", workspace(spark, "p")).trigger(availableNow=True).start())
    assert passed == tie[:2]
    assert rows(ch.latest_change_per_key(feed(spark, passed), ["id"])) == rows(ch.latest_change_per_key(feed(spark, tie), ["id"]))


def test_repeats_within_the_delay_are_dropped(spark, rows):
    path, out = workspace(spark, "f"), workspace(spark, "o")
    at = datetime(2024, 1, 1)
    sent = [(1, 10, at), (1, 11, at + timedelta(seconds=5)), (1, 10, at), (2, 10, at)]
    for row in sent:
        spark.createDataFrame([row], "id int, seq bigint, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    stream = feeds.change_stream(spark, path, "id int, seq bigint, ts timestamp_ntz", max_files=1)
    clean = feeds.without_repeats(stream, ["id", "seq"], "ts", "10 minutes")
    feeds.run_available(feeds.stream_append(clean, out, workspace(spark, "p")))
    assert rows(spark.read.schema(clean.schema).parquet(out), "id", "seq") == [(1, 10), (1, 11), (2, 10)]


def test_flush_policy():
    assert feeds.flush_policy()["max_bytes"] == 104_857_600
    assert feeds.flush_policy(100)["max_bytes"] == 50_000_000
    assert feeds.flush_policy(10_000)["max_bytes"] == 104_857_600
    assert feeds.flush_policy(mean_file_rows=200_000.0)["max_files"] == 2
    assert feeds.flush_policy(mean_file_rows=10**6)["max_files"] == 1
    assert feeds.flush_policy()["trigger"] == {"processingTime": "10 seconds"}


def test_silent_keys_are_told_once_and_forgotten(spark):
    state.use_rocksdb(spark)
    path, told = workspace(spark, "f"), []
    at = datetime(2024, 1, 1)
    minutes = [[(1, 0), (2, 0), (None, 1)], [(1, 8), (2, 5)], [(3, 17)], [(3, 24), (2, 4), (4, None)], [(1, 25)], [(3, 50)]]
    for batch in minutes:
        rows = [(k, None if m is None else at + timedelta(minutes=m)) for k, m in batch]
        spark.createDataFrame(rows, "id int, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    stream = feeds.change_stream(spark, path, "id int, ts timestamp_ntz", max_files=1)
    silent = state.silent_keys(stream, ["id"], "ts", after="10 minutes", delay="1 minute")
    query = silent.writeStream.outputMode("append").foreachBatch(lambda df, k: told.extend(tuple(r) for r in df.collect()))
    feeds.run_available(query.option("checkpointLocation", workspace(spark, "p")).trigger(availableNow=True).start())
    found = sorted((k, (t - at).total_seconds() / 60) for k, t in told if k is not None) + [(k, (t - at).total_seconds() / 60) for k, t in told if k is None]
    assert found == [(1, 8), (1, 25), (2, 5), (3, 24), (None, 1)]
