"""Structured Streaming queries (survey group M, and the stream source of group A).

Each runs a stream over all of its input to the end, in folders of its own inside the shared folder,
and returns the table it leaves behind, which must equal the batch result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.operators import changes as ch
from rowtide.session import shuffle_width, workspace
from rowtide.sources.merge_store import KeyedTable
from rowtide.streaming import feeds, state
from suite import standins as st
from suite.registry import query, table
from suite.replication import BUCKETS, KEY, MULTI_SQL, final_sql, keyed_orders, multi_feed, multi_rows, shown, table_set

BATCHES = 4

# Changes of users native to the events: signup inserts, error deletes, the rest updates.
_EVENT_OP = "case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end"
LIVE_USERS_SQL = """select user_id, event_type, value from events
  qualify row_number() over (partition by user_id order by event_id desc) = 1 and event_type <> 'error'"""


def landed(spark, df, label: str, files: int | None = None) -> str:
    """The feed written to a folder of change files (one per shuffle partition unless given), in no order, for a stream to pick up."""
    path = workspace(spark, label)
    mixed = df.repartition(files or shuffle_width(spark), F.xxhash64("seq", "op"))
    mixed.write.parquet(path)
    return path


def in_batches(spark) -> int:
    """Files per micro-batch that make about ``BATCHES`` batches of what :func:`landed` wrote."""
    return max(1, shuffle_width(spark) // BATCHES)


def orders_feed(spark, sf, label: str, files: int | None = None):
    feed = st.feed(spark, sf)
    path = landed(spark, feed, label, files)
    return path, feed.schema, lambda: feeds.change_stream(spark, path, feed.schema, in_batches(spark))


def folder(path: str) -> str:
    """A table's path as a pattern, so that a single file can be streamed as well as a folder."""
    return path[:-1] + "[" + path[-1] + "]"


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return feeds.change_stream(spark, folder(f"{sf}/events.parquet"), schema)


def user_changes(events):
    return events.select("user_id", "event_type", "value", F.expr(_EVENT_OP).alias("op"), F.col("event_id").alias("seq"))


@query(f"select user_id, event_type, value, {_EVENT_OP} as op, event_id as seq from events")
def change_stream_source(spark, sf):
    """The native feed of the events, read as a stream and kept as it comes."""
    changes = user_changes(event_stream(spark, sf))
    path, checkpoint = workspace(spark, "changes"), workspace(spark, "changes-progress")
    feeds.run_available(feeds.stream_append(changes, path, checkpoint))
    return spark.read.schema(changes.schema).parquet(path)


@query(final_sql())
def stream_upsert(spark, sf):
    base = st.base(spark, sf)
    target = keyed_orders(spark, "stream-upsert", base)
    target.load(base)
    _, _, stream = orders_feed(spark, sf, "orders-feed")
    feeds.run_available(feeds.stream_into(stream(), target, workspace(spark, "upsert-progress")))
    return shown(target.read())


@query(MULTI_SQL)
def stream_multi_table(spark, sf):
    target = table_set(spark, sf, "stream-tables")
    path = landed(spark, multi_feed(spark, sf), "tables-feed")
    stream = feeds.change_stream(spark, path, target.feed_schema(), in_batches(spark))
    feeds.run_available(feeds.stream_into(stream, target, workspace(spark, "tables-progress")))
    return multi_rows(target)


@query(final_sql())
def stream_resume(spark, sf):
    """Stopped and restarted from its checkpoint: files that came in between are added, none twice."""
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    target = keyed_orders(spark, "stream-resume", base)
    target.load(base)
    path, checkpoint = workspace(spark, "resumed-feed"), workspace(spark, "resume-progress")
    late = F.pmod(F.xxhash64("o_orderkey", "seq"), F.lit(2)) == 0
    for part in (feed.where(~late), feed.where(late), None):  # the last run finds nothing new
        if part is not None:
            part.write.mode("append").parquet(path)
        stream = feeds.change_stream(spark, path, feed.schema)
        feeds.run_available(feeds.stream_into(stream, target, checkpoint))
    return shown(target.read())


@query(final_sql())
def stream_exactly_once(spark, sf):
    """A progress lost after its batches were written: they are all replayed onto the same target."""
    base = st.base(spark, sf)
    target = keyed_orders(spark, "stream-once", base)
    target.load(base)
    _, _, stream = orders_feed(spark, sf, "once-feed")
    for _ in range(2):
        feeds.run_available(feeds.stream_into(stream(), target, workspace(spark, "once-progress")))
    return shown(target.read())


@query(LIVE_USERS_SQL)
def keyed_state_latest(spark, sf):
    """Latest change per user held in the stream's own state; what passes ends as the live users."""
    state.use_rocksdb(spark)
    passed = state.latest_by_state(user_changes(event_stream(spark, sf)), ["user_id"])
    path, checkpoint = workspace(spark, "passed"), workspace(spark, "passed-progress")

    def keep(batch, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = passed.writeStream.outputMode("update").foreachBatch(keep)
    feeds.run_available(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    kept = spark.read.schema(passed.schema).parquet(path)
    return ch.live_rows(ch.latest_change_per_key(kept.select(*passed.columns), ["user_id"]))


@query(final_sql())
def keyed_state_latest_jvm(spark, sf):
    """The same rule as a streaming aggregate, feeding a keyed table in update mode.

    A batch has a part of the feed, not of its files: each costs a commit of every partition's state and a delta more to read.
    """
    base = st.base(spark, sf)
    target = keyed_orders(spark, "stream-latest", base)
    target.load(base)
    path, schema, _ = orders_feed(spark, sf, "latest-feed")
    latest = state.latest_in_stream(feeds.change_stream(spark, path, schema, in_batches(spark)), KEY)
    writer = latest.writeStream.outputMode("update").foreachBatch(target.apply)
    feeds.run_available(writer.option("checkpointLocation", workspace(spark, "latest-progress")).trigger(availableNow=True).start())
    return shown(target.read())


@query(final_sql())
def micro_batch_policy(spark, sf):
    """Batches limited by rows as the flush rules say: 400 rows here, so that the input takes several.

    Of files with more rows than that a batch takes one, so the feed comes in few files: its batches grow with it, not their number.
    """
    base = st.base(spark, sf)
    target = keyed_orders(spark, "stream-policy", base)
    target.load(base)
    path, schema, _ = orders_feed(spark, sf, "policy-feed", min(shuffle_width(spark), 4 * BATCHES))
    policy = feeds.flush_policy(mean_file_rows=feeds.mean_rows_per_file(spark.read.schema(schema).parquet(path)), rows=400)
    stream = feeds.change_stream(spark, path, schema, max_files=policy["max_files"])
    feeds.run_available(feeds.stream_into(stream, target, workspace(spark, "policy-progress"), compact_every=4))
    return shown(target.read())


@query(final_sql())
def stream_late_changes(spark, sf):
    """Newest changes first, compaction between the batches: older ones must not win afterwards."""
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    target = keyed_orders(spark, "stream-late", base)
    target.load(base)
    path, checkpoint = workspace(spark, "late-feed"), workspace(spark, "late-progress")
    newest = F.col("seq") % 10 >= 2
    for part in (feed.where(newest), feed.where(~newest)):
        part.write.mode("append").parquet(path)
        stream = feeds.change_stream(spark, path, feed.schema)
        feeds.run_available(feeds.stream_into(stream, target, checkpoint))
        target.compact()
    return shown(target.read())


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem")
def stream_append(spark, sf):
    rows = table(spark, sf, "lineitem")
    stream = feeds.change_stream(spark, folder(f"{sf}/lineitem.parquet"), rows.schema)
    stream = stream.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    path, checkpoint = workspace(spark, "appended"), workspace(spark, "append-progress")
    for _ in range(2):  # run again from the same progress: nothing is doubled
        feeds.run_available(feeds.stream_append(stream, path, checkpoint))
    return spark.read.schema(stream.schema).parquet(path)


@query(f"select entity, total_reads, total_updates, total_io, {st.tier_sql('total_updates')} as category from ({st.ROLLUP_SQL})")
def stream_activity_tiers(spark, sf):
    kind = F.col("event_type")
    events = event_stream(spark, sf).withColumnRenamed("user_id", "entity")
    schema = "entity bigint, total_reads bigint, total_updates bigint, total_io bigint, category string"
    schema = spark.createDataFrame([], schema).schema
    target = KeyedTable(spark, workspace(spark, "tiers"), ["entity"], schema, BUCKETS)
    started = state.stream_activity(
        events,
        "entity",
        kind.isin("view", "click"),
        kind.isin("purchase", "signup", "error"),
        target,
        workspace(spark, "tiers-progress"),
        st.HIGH,
        st.LOW,
    )
    feeds.run_available(started)
    return target.read()


@query(LIVE_USERS_SQL)
def apply_changes_of_events(spark, sf):
    """The native feed in batch: no snapshot, the live users come from changes alone."""
    feed = user_changes(table(spark, sf, "events"))
    return ch.live_rows(ch.latest_change_per_key(feed, ["user_id"]))
