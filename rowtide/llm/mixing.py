"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.tables import numbered, stored
from rowtide.session import shuffle_width

#: The stream of all sources that have no weight of their own, null included.
REST = "(rest)"


@dataclass(frozen=True)
class Phase:
    """A stretch of the schedule with one set of streams: from ``slot`` on, the pattern repeats every ``period`` slots."""

    slot: int
    period: int
    #: stream -> (blocks it has placed before this phase, its blocks per period)
    streams: dict[str, tuple[int, int]]
    #: (stream, number of its block in the period, slot in the period, release, deadline)
    pattern: list[tuple[str, int, int, int, int]]
    #: slots in this phase
    length: int


def pattern(weights: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """Earliest deadline first over one period of as many slots as the weights sum to.

    Block j of a stream of weight q in period Q is released at floor(j Q / q) and due at ceil((j + 1) Q / q). As the shares
    sum to 1, no slot idles, every deadline is met, and a stream is less than one block off its share at any slot. Ties
    go to the larger weight, then the name.
    """
    total = sum(weights.values())
    waiting = sorted((j * total // q, name, j) for name, q in weights.items() for j in range(q))
    ready: list[tuple] = []
    out, at = [], 0
    for slot in range(total):
        while at < len(waiting) and waiting[at][0] <= slot:
            release, name, j = waiting[at]
            q = weights[name]
            heapq.heappush(ready, (-(-(j + 1) * total // q), -q, name, j, release))
            at += 1
        deadline, _, name, j, release = heapq.heappop(ready)
        out.append((name, j, slot, release, deadline))
    return out


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[Phase]:
    """The whole schedule: when a stream has no block left, the others go on with their weights among themselves."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    slot, out = 0, []
    while left:
        common = reduce(gcd, (weights[s] for s in left))
        shares = {s: weights[s] // common for s in sorted(left)}
        period = sum(shares.values())
        plan = pattern(shares)
        place = {(name, j): at for name, j, at, _, _ in plan}
        last = {s: (n - 1) // shares[s] * period + place[s, (n - 1) % shares[s]] for s, n in left.items()}
        length = min(last.values()) + 1
        out.append(Phase(slot, period, {s: (done[s], shares[s]) for s in left}, plan, length))
        whole, part = divmod(length, period)
        for s in list(left):
            placed = whole * shares[s] + sum(1 for name, _, at, _, _ in plan if name == s and at < part)
            done[s] += placed
            left[s] -= placed
            if not left[s]:
                del left[s]
        slot += length
    return out


def stream_of(source: Column, weights: dict[str, int]) -> Column:
    named = [s for s in weights if s != REST]
    return F.when(source.isin(named), source).otherwise(F.lit(REST))


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int = 32, seed: int = 11, source: str = "source", whole: bool = False) -> DataFrame:
    """doc_id, ``stream``, ``block``, ``phase``, ``slot``, ``release``, ``deadline`` and ``position`` of every row of ``docs``.

    Each stream (a source with a weight, or all others together) is shuffled by a seeded hash of doc_id and cut into
    blocks of ``block_rows`` rows, the last one maybe shorter. Blocks get slots by ``phases``; ``position`` is the row's
    gapless place in the mix. Weights are whole numbers above 0; the schedule's size depends on them alone. No row is
    dropped or repeated. Null ids and sources are rows like others; rows equal in id and text are interchangeable.
    With ``whole`` all columns of ``docs`` come along as the struct ``_row``. An empty table gives no rows.
    """
    weights = {REST: 1, **weights}
    if any(w < 1 or int(w) != w for w in weights.values()):
        raise ValueError("weights are whole numbers above 0")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        stream_of(F.col(source), weights).alias("stream"),
        F.xxhash64(F.lit(seed), "doc_id").alias("_h"),
        F.xxhash64("text").alias("_t"),
        *([F.struct(*docs.columns).alias("_row")] if whole else []),
    )
    rows = numbered(narrow, ["_h", "doc_id", "_t"], group="stream", name="_n")
    sizes = {r["stream"]: r["n"] for r in rows.groupBy("stream").agg(F.count("*").alias("n")).collect()}  # a row per weight at most
    plan = phases({s: -(-n // block_rows) for s, n in sizes.items()}, weights)
    steps, slots = _schedule_rows(docs.sparkSession, plan)
    rows = rows.withColumn("block", F.call_function("div", F.col("_n"), F.lit(block_rows).cast("long")))
    # both sides are bounded by the weights: a row per phase and stream, and per slot of each phase's pattern
    rows = rows.join(F.broadcast(steps), "stream").where("block >= _from and block < _until")
    rows = rows.withColumn("_j", F.pmod(F.col("block") - F.col("_from"), F.col("_share")))
    rows = rows.join(F.broadcast(slots), ["phase", "stream", "_j"])
    turn = F.call_function("div", F.col("block") - F.col("_from"), F.col("_share")) * F.col("_period") + F.col("_start")
    rows = rows.withColumns({c: turn + F.col(f"_{c}") for c in ("slot", "release", "deadline")})
    missing = F.lit(0).cast("long")
    for slot, lack in _short_blocks(sizes, block_rows, plan):
        missing = missing + F.when(F.col("slot") > slot, F.lit(lack)).otherwise(F.lit(0))
    position = F.col("slot") * block_rows + F.pmod("_n", F.lit(block_rows).cast("long")) - missing
    rows = rows.withColumn("position", position)
    return rows.select("doc_id", "stream", "block", "phase", "slot", "release", "deadline", "position", *(["_row"] if whole else []))


def _schedule_rows(spark: SparkSession, plan: list[Phase]) -> tuple[DataFrame, DataFrame]:
    steps, slots = [], []
    for i, p in enumerate(plan):
        for s, (done, share) in p.streams.items():
            after = plan[i + 1].streams.get(s) if i + 1 < len(plan) else None
            steps.append((s, i, done, after[0] if after else 2**62, share, p.period, p.slot))
        slots += [(i, *row) for row in p.pattern]
    return (
        spark.createDataFrame(steps, "stream string, phase int, _from long, _until long, _share long, _period long, _start long"),
        spark.createDataFrame(slots, "phase int, stream string, _j long, _slot long, _release long, _deadline long"),
    )


def _short_blocks(sizes: dict[str, int], block_rows: int, plan: list[Phase]) -> list[tuple[int, int]]:
    """(slot, rows lacking) of each stream's last block where it isn't full."""
    out = []
    for s, n in sizes.items():
        if n % block_rows:
            block = n // block_rows
            p = next(p for p in reversed(plan) if s in p.streams and p.streams[s][0] <= block)
            done, share = p.streams[s]
            at = next(at for name, j, at, _, _ in p.pattern if name == s and j == (block - done) % share)
            out.append((p.slot + (block - done) // share * p.period + at, block_rows - n % block_rows))
    return out


def mixed(docs: DataFrame, weights: dict[str, int], block_rows: int = 32, seed: int = 11, source: str = "source") -> DataFrame:
    """``docs`` in the order of the mix: read in order of its partitions, the rows follow ``position``. All columns stay."""
    rows = mix(docs, weights, block_rows, seed, source, whole=True)
    rows = stored(rows.select("position", "_row"), "mixed").repartitionByRange(shuffle_width(docs.sparkSession), "position")
    return rows.sortWithinPartitions("position").select("_row.*")
