"""A snapshot taken chunk by chunk while the feed of changes goes on.

Each chunk of the key is read between two marks, the feed's position before and after. What changed between them is
left to the feed; the chunk's other rows stood at the second mark as they were read, so they enter the target as reads of
that position. Earlier changes that arrive later lose to them, later ones win, and nothing has to stop: once all chunks are done
and the feed has been applied up to the last mark, the target is the source. A finished chunk leaves a mark in the progress
folder; a run that was ended goes on with the others, and a chunk taken twice does no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.changes import SEQ, as_state, without_keys
from rowtide.session import child_folders, make_mark, pinned
from rowtide.sources.merge_store import KeyedTable
from rowtide.sources.snapshot import CHUNK_SIZE, key_chunk_plan, key_ranges, sql_literal


class Chunk(NamedTuple):
    """A range of the key: from ``lo`` (None: open, nulls too) up to but without ``hi`` (None: open)."""

    number: int
    lo: object
    hi: object

    def condition(self, key: str, collation: str | None = None) -> Column:
        value = F.collate(key, collation) if collation else F.col(key)
        found = F.lit(True)
        if self.hi is not None:
            found = value < F.lit(self.hi)
        if self.lo is None:
            return value.isNull() | found
        return found & (value >= F.lit(self.lo))

    def predicate(self, key: str, literal: Callable[[object], str] = sql_literal) -> str:
        """The same range in the source's SQL, for ``spark.read.jdbc(predicates=[…])``."""
        lows = [None, *[v for v in (self.lo, self.hi) if v is not None]]
        return key_ranges(lows, literal, key)[0 if self.lo is None else 1]


#: Reads the rows of a chunk as the source is now.
Read = Callable[[Chunk], DataFrame]


class IncrementalSnapshot:
    """Chunks of one source table on their way into a keyed table. ``progress`` is a folder of its own."""

    def __init__(self, spark: SparkSession, target: KeyedTable, progress: str, key: str | None = None, collation: str | None = None):
        self.spark = spark
        self.target = target
        self.progress = progress.rstrip("/")
        self.key = key or target.keys[0]
        self.collation = collation

    def plan(self, keys: DataFrame, size: int = CHUNK_SIZE) -> None:
        """Cut the key into chunks of ``size`` keys, once; a resumed run keeps the first plan.

        A chunk is one Spark job and its bounds come to the driver: for large tables choose ``size`` so that a chunk fills
        the cluster. Keys that appear later fall into these ranges too, as the first and last are open.
        """
        if child_folders(self.spark, f"{self.progress}/plan"):
            return
        chunks = key_chunk_plan(keys, self.key, size, self.collation).select("chunk_id", F.col("lo").alias("lo"))
        plain = chunks.withColumn("lo", F.collate("lo", "UTF8_BINARY")) if self.collation else chunks
        plain.coalesce(1).write.mode("overwrite").parquet(f"{self.progress}/plan")

    def chunks(self) -> list[Chunk]:
        rows = self.spark.read.parquet(f"{self.progress}/plan").orderBy("chunk_id").collect()
        lows = [None, *[r.lo for r in rows[1:]]]
        return [Chunk(k, lo, hi) for k, (lo, hi) in enumerate(zip(lows, [*lows[1:], None]))]

    def done(self) -> dict[int, tuple[int, int]]:
        """Marks (before, after) of the finished chunks; of one taken twice the later."""
        found: dict[int, tuple[int, int]] = {}
        for name in child_folders(self.spark, f"{self.progress}/done"):
            number, low, high = (int(x) for x in name.split("_"))
            found[number] = max(found.get(number, (low, high)), (low, high), key=lambda m: m[1])
        return found

    def pending(self) -> list[Chunk]:
        done = self.done()
        return [c for c in self.chunks() if c.number not in done]

    def consistent_from(self) -> int | None:
        """The position the feed must have been applied up to for the target to be the source; None while chunks are pending."""
        done = self.done()
        return None if self.pending() else max((high for _, high in done.values()), default=None)

    def take(self, chunk: Chunk, read: Read, position: Callable[[], int], feed: Callable[[], DataFrame]) -> tuple[int, int]:
        """Read one chunk between its marks and hand it to the target.

        ``position`` is the feed's position at the source now; ``feed`` gives the changes so far, at least all up to a
        position that was reported. Only those between the marks are read of it.
        """
        low = position()
        rows = pinned(read(chunk))  # read here, not when the target writes
        high = position()
        changed = feed().where((F.col(SEQ) > low) & (F.col(SEQ) <= high))
        self.target.apply(chunk_as_changes(rows, changed, self.target.keys, high).select(*self.target.columns, "op", SEQ), chunk.number)
        make_mark(self.spark, f"{self.progress}/done/{chunk.number}_{low}_{high}")
        return low, high

    def run(self, read: Read, position: Callable[[], int], feed: Callable[[], DataFrame], most: int | None = None) -> int:
        """Take the pending chunks in order, ``most`` at a time; returns how many are left."""
        left = self.pending()
        for chunk in left[:most]:
            self.take(chunk, read, position, feed)
        return max(0, len(left) - most) if most is not None else 0


def chunk_as_changes(rows: DataFrame, changed: DataFrame, keys: Sequence[str], high: int) -> DataFrame:
    """Rows read between two marks as reads of the second, without the keys that ``changed`` (the feed between them) has."""
    return as_state(without_keys(rows, changed, keys), high)
