"""Keyed state kept by the stream itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rowtide.functions.measures import tier
from rowtide.operators.activity import CATEGORY, READS, TOTAL, WRITES
from rowtide.operators.changes import OP, SEQ, UPDATE, latest_change_per_key, op_rank
from rowtide.sources.merge_store import KeyedTable
from rowtide.streaming.feeds import _start, tidy

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_RANK = "change_rank"
_PAYLOAD = "change_payload"
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: larger than memory, checkpointed by difference."""
    spark.conf.set(_PROVIDER, ROCKSDB)


def _latest(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """Rows of the highest seq and op per key; several only where they differ in payload alone."""
    for column in (SEQ, _RANK):
        pdf = pdf[pdf[column] == pdf.groupby(keys, dropna=False)[column].transform("max")]
    return pdf.drop_duplicates([*keys, _PAYLOAD])


def _mark(payload: str) -> str:
    return hashlib.blake2b(payload.encode(), digest_size=8).hexdigest()


class _LatestOnly(StatefulProcessor):
    """Holds the order of the last change emitted per key and lets only later ones pass."""

    def __init__(self, keys: list[str]) -> None:
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seq bigint, rank int, mark string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterable[pd.DataFrame]:
        best = None
        for pdf in rows:
            best = _latest(pdf if best is None else pd.concat([best, pdf], ignore_index=True), self.keys)
        order = (int(best[SEQ].iloc[0]), int(best[_RANK].iloc[0]))
        last = tuple(self.seen.get()) if self.seen.exists() else None
        if last is not None and order < last[:2]:
            return
        marks = best[_PAYLOAD].map(_mark)
        fresh = best if last is None or order > last[:2] else best[marks != last[2]]
        if len(fresh):
            self.seen.update((*order, _mark(fresh[_PAYLOAD].iloc[-1])))
            yield fresh

    def close(self) -> None:
        pass


class _Silence(StatefulProcessor):
    """Remembers when a key was last heard of; a timer tells when that is too long ago, and the key is forgotten."""

    def __init__(self, keys: list[str], after_ms: int) -> None:
        self.keys = keys
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterable[pd.DataFrame]:
        heard = sorted({int(ms) for pdf in rows for ms in pdf["seen_ms"]})
        first = last = self.last.get()[0] if self.last.exists() else None
        if last is None:  # what is older than a silence that could have been told starts none
            heard = [ms for ms in heard if ms + self.after_ms > timerValues.getCurrentWatermarkInMs()]
        silences = []
        for ms in heard:
            if last is not None and ms - last >= self.after_ms:
                silences.append(last)
            last = ms if last is None else max(last, ms)
        if last != first:
            if first is not None:
                self.handle.deleteTimer(first + self.after_ms)
            self.last.update((last,))
            self.handle.registerTimer(last + self.after_ms)
        if silences:
            yield self._told(key, silences)

    def _told(self, key, silences: list[int]) -> pd.DataFrame:
        return pd.DataFrame({**{k: [v] * len(silences) for k, v in zip(self.keys, key)}, "seen_ms": silences})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterable[pd.DataFrame]:
        if self.last.exists():
            last = self.last.get()[0]
            self.last.clear()
            yield self._told(key, [last])

    def close(self) -> None:
        pass


def silent_keys(events: DataFrame, keys: Sequence[str], ts: str, after: str, delay: str) -> DataFrame:
    """Live alert: keys not heard of for ``after`` (such as ``30 minutes``) of event time, with when they were last (``last_seen``).

    A key is told once per silence and then forgotten, so state holds only keys heard of within ``after`` plus ``delay``. Events may be late
    by ``delay``; a wall-clock ``ts`` is read in the session time zone, and rows without one are left out.
    """
    if events.sparkSession.conf.get(_PROVIDER, "") != ROCKSDB:
        raise ValueError("keyed state of this kind needs RocksDB: call use_rocksdb(spark) first")
    keys = list(keys)
    timed = events.select(*keys, F.col(ts).cast("timestamp").alias("seen_at")).where(F.col("seen_at").isNotNull())
    timed = timed.withWatermark("seen_at", delay).withColumn("seen_ms", F.unix_millis("seen_at"))
    after_ms = int(timed.sparkSession.sql(f"select unix_millis(timestamp '1970-01-01 00:00:00Z' + interval {after})").first()[0])
    out = StructType([*[timed.schema[k] for k in keys], StructField("seen_ms", LongType())])
    found = timed.groupBy(*keys).transformWithStateInPandas(_Silence(keys, after_ms), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return found.select(*keys, F.timestamp_millis("seen_ms").alias("last_seen"))


def latest_by_state(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that move a key forward; stale and repeated ones are held back.

    Every Arrow batch is first cut to the latest of each key where it was read, so a key that makes
    up much of the feed reaches its state as a few rows. The payload crosses Python as one JSON
    text, so its types are not touched. Of changes with equal seq and op every payload passes, and
    the receiver settles them as :func:`rowtide.operators.changes.latest_change_per_key` does.
    """
    if feed.sparkSession.conf.get(_PROVIDER, "") != ROCKSDB:
        raise ValueError("keyed state of this kind needs RocksDB: call use_rocksdb(spark) first")
    keys = list(keys)
    payload = StructType([f for f in feed.schema.fields if f.name not in {*keys, SEQ, OP}])
    packed = feed.select(
        *keys,
        SEQ,
        op_rank(F.col(OP)).cast("int").alias(_RANK),
        F.to_json(F.struct(F.col(OP), *payload.names), _JSON).alias(_PAYLOAD),
    )

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _latest(pdf, keys)

    passed = (
        packed.mapInPandas(combine, packed.schema)
        .groupBy(*keys)
        .transformWithStateInPandas(
            _LatestOnly(keys), outputStructType=packed.schema, outputMode="Update", timeMode="None"
        )
    )
    unpacked = StructType([StructField(OP, StringType()), *payload.fields])
    row = passed.withColumn(_PAYLOAD, F.from_json(_PAYLOAD, unpacked, _JSON))
    return row.select(*[F.col(c) if c in {*keys, SEQ} else F.col(f"{_PAYLOAD}.{c}") for c in feed.columns])


def latest_in_stream(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest change of every key a batch touched, by an aggregate held in the stream's state; wholly in the JVM.

    Write it in update mode. A stale change emits its key's unchanged latest row again, which a keyed target takes without
    effect; :func:`latest_by_state` holds those back. Combines before the shuffle.
    """
    return latest_change_per_key(feed, keys)


def stream_activity(
    events: DataFrame,
    entity: str,
    reads,
    writes,
    target: KeyedTable,
    checkpoint: str,
    high: int,
    low: int,
    trigger: dict | None = None,
    compact_every: int | None = None,
    keep: int = 2,
) -> StreamingQuery:
    """Live counters and tier per entity; deltas are folded as :func:`rowtide.streaming.feeds.stream_into` does.

    The counters are a streaming aggregate, combined before the shuffle. Each batch hands on only
    the entities it touched, as upserts into ``target``; a tier can change with any of them. Their ``seq`` goes on from the
    target's highest, so the updates of a query with a new checkpoint are later than all before.
    """
    highest = target.state().agg(F.max(SEQ).alias("seq")).first().seq
    start = 0 if highest is None else max(0, highest + 1)
    running = events.groupBy(entity).agg(F.count_if(reads).alias(READS), F.count_if(writes).alias(WRITES))
    running = running.withColumns(
        {TOTAL: F.col(READS) + F.col(WRITES), CATEGORY: tier(F.col(WRITES), high, low)}
    )

    def upsert(batch: DataFrame, batch_id: int) -> None:
        changes = batch.withColumns({OP: F.lit(UPDATE), SEQ: F.lit(start + batch_id).cast("bigint")})
        target.apply(changes, batch_id)
        tidy(target, batch_id, compact_every, keep)

    return _start(running.writeStream.outputMode("update").foreachBatch(upsert), checkpoint, trigger)
