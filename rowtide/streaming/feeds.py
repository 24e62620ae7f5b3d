"""Streams of changes, and streaming queries that keep targets in step with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowtide.sources.merge_store import BASE_SHARE, KeyedTable
from rowtide.sources.table_set import TableSet

# A batch is flushed after this time, these bytes or these rows.
FLUSH_INTERVAL = "10 seconds"
FLUSH_BYTES = 104_857_600
FLUSH_ROWS = 500_000


def change_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Unbounded change feed over a folder that change files arrive in."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def flush_policy(
    mean_row_bytes: int | None = None, mean_file_rows: float | None = None, rows: int = FLUSH_ROWS
) -> dict[str, object]:
    """Trigger and input limits with the flush rules of a buffered sink.

    The time rule is the trigger. The byte rule limits a batch's input; with a mean row size known, the row
    rule lowers it further. File bytes are compressed, so where files are known by their rows (:func:`mean_rows_per_file`)
    the row rule is kept by ``max_files`` instead.
    """
    limit = FLUSH_BYTES if mean_row_bytes is None else min(FLUSH_BYTES, rows * mean_row_bytes)
    policy = {"trigger": {"processingTime": FLUSH_INTERVAL}, "max_bytes": limit}
    return policy if mean_file_rows is None else policy | {"max_files": max(1, int(rows // max(1.0, mean_file_rows)))}


def mean_rows_per_file(files: DataFrame) -> float:
    """Rows per file of what a feed's folder holds so far; Parquet answers from its footers' counts."""
    found = files.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).agg(F.avg("n").alias("n")).first()
    return found.n or 0.0


def without_repeats(feed: DataFrame, identity: Sequence[str], ts: str, delay: str) -> DataFrame:
    """A feed without changes delivered again within ``delay`` of their event time.

    Watermarks need a zoned timestamp, so a wall-clock ``ts`` is read in the session time zone.
    """
    timed = feed.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(identity)).drop("_event_time")


def _start(writer, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_into(
    feed: DataFrame,
    target: KeyedTable | TableSet,
    checkpoint: str,
    trigger: dict | None = None,
    compact_every: int | None = None,
    keep: int = 2,
    share: float = BASE_SHARE,
) -> StreamingQuery:
    """Apply a feed to a keyed table or a set of tables, one delta per micro-batch.

    A batch replayed after a failure is a second delta with the same changes, which alters nothing. With
    ``compact_every`` the writer itself folds its deltas after every so many batches, into the base once they come to
    ``share`` of it, and deletes what the last ``keep`` versions do not need, so a stream may run for weeks. Give each
    query its own checkpoint and target.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        target.apply(rows, batch_id)
        tidy(target, batch_id, compact_every, keep, share)

    return _start(feed.writeStream.foreachBatch(batch), checkpoint, trigger)


def tidy(target: KeyedTable | TableSet, batch_id: int, every: int | None, keep: int, share: float = BASE_SHARE) -> None:
    """Fold a stream's deltas after every so many batches and delete what is no longer read."""
    if every and (batch_id + 1) % every == 0:
        target.fold(share)
        target.vacuum(keep)


def stream_append(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream without key to a folder; the sink's log keeps rows from being doubled."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, trigger)


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to end and raise what made it fail."""
    query.awaitTermination()
