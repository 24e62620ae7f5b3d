"""Incremental snapshots beside a feed, against the source's final rows; chunk conditions in the source's order."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators.changes import apply_changes
from rowtide.session import workspace
from rowtide.sources import snapshot as snap
from rowtide.sources.incremental import IncrementalSnapshot
from rowtide.sources.merge_store import KeyedTable

ROW = "id string, v int"
CHANGE = f"{ROW}, op string, seq bigint"


class Source:
    """A table that changes while it is read: its rows after so many of its changes."""

    def __init__(self, seed: int, keys: int = 60, changes: int = 240):
        rng = random.Random(seed)
        names = [f"{c}{n}" for n in range(keys // 4) for c in "aAbB"] + [None]
        self.rows = {k: -1 for k in rng.sample(names[:-1], keys // 2)} | {None: -1}
        self.states, self.changes, self.now = [dict(self.rows)], [], 0
        state = dict(self.rows)
        for seq in range(1, changes + 1):
            k = rng.choice(names)
            op = rng.choice("ud") if k in state else "c"
            self.changes.append((k, None if op == "d" else seq, op, seq))
            if op == "d":
                del state[k]
            else:
                state[k] = seq
            self.states.append(dict(state))

    def frame(self, spark, state):
        return spark.createDataFrame(list(state.items()), ROW)

    def feed(self, spark, upto=None):
        return spark.createDataFrame([c for c in self.changes if upto is None or c[3] <= upto], CHANGE)


class Killed(Exception):
    pass


@pytest.mark.parametrize("seed", range(2))
def test_chunks_and_feed_make_the_source(spark, rows, seed):
    source, rng = Source(seed), random.Random(seed)
    target = KeyedTable(spark, workspace(spark, "inc"), ["id"], source.frame(spark, source.rows).schema, buckets=2)
    progress, marks = workspace(spark, "progress"), []

    def position():
        source.now = min(len(source.changes), source.now + rng.randrange(20))
        marks.append(source.now)
        return source.now

    def read(chunk):
        source.now = min(len(source.changes), source.now + rng.randrange(10))
        return source.frame(spark, source.states[source.now]).where(chunk.condition("id"))

    def feed():
        return source.feed(spark, source.now)

    run = IncrementalSnapshot(spark, target, progress)
    run.plan(source.frame(spark, source.rows).select("id"), size=9)
    assert run.run(read, position, feed, most=1) == len(run.chunks()) - 1 > 1
    target.apply(source.feed(spark, source.now // 2), 900)

    def fails(chunk):
        raise Killed

    with pytest.raises(Killed):
        run.take(run.pending()[0], fails, position, feed)
    again = IncrementalSnapshot(spark, target, progress)
    again.plan(source.frame(spark, {}).select("id"), size=1)  # the first plan stays
    assert again.chunks() == run.chunks() and again.consistent_from() is None
    again.take(again.chunks()[0], read, position, feed)  # taken twice
    again.run(read, position, feed)
    assert again.pending() == [] and again.consistent_from() == max(high for _, high in again.done().values())
    target.apply(source.feed(spark, again.consistent_from()), 901)
    assert rows(target.read()) == sorted(source.states[again.consistent_from()].items(), key=repr)
    target.apply(source.feed(spark), 902)
    assert rows(target.read()) == sorted(source.states[-1].items(), key=repr)
    assert rows(target.read()) == rows(apply_changes(source.frame(spark, source.rows), source.feed(spark), ["id"]))


KEYS = ["A", "a", "B", "b", "C", "c", "D", "d", None, "a'x"]


@pytest.mark.parametrize("collation", ["UTF8_BINARY", "UTF8_LCASE"])
def test_conditions_take_every_row_once_in_the_sources_order(spark, collation):
    keys = spark.createDataFrame([(k,) for k in KEYS], "k string")
    at_source = keys.select(F.collate("k", collation).alias("k"))  # compares as the source does
    for predicates in (snap.jdbc_predicates(snap.key_chunk_plan(keys, "k", 2, collation), "k", quote="'"), snap.hash_predicates("hash(k)", 3)):
        quoted = [p.replace("'a''x'", "\"a'x\"") for p in predicates]
        found = [r.k for p in quoted for r in at_source.where(p).collect()]
        assert len(predicates) > 2 and sorted(found, key=repr) == sorted(KEYS, key=repr)
    plan = IncrementalSnapshot(spark, KeyedTable(spark, workspace(spark, "t"), ["k"], keys.schema), workspace(spark, "p"), collation=collation)
    plan.plan(keys, 2)
    found = [r.k for c in plan.chunks() for r in keys.where(c.condition("k", collation)).collect()]
    assert sorted(found, key=repr) == sorted(KEYS, key=repr)
    sql = [c.predicate("k").replace("'a''x'", "\"a'x\"") for c in plan.chunks()]
    assert sorted([r.k for p in sql for r in at_source.where(p).collect()], key=repr) == sorted(KEYS, key=repr)


def test_binary_and_number_keys_are_written_in_the_sources_form(spark):
    plan = snap.key_chunk_plan(spark.createDataFrame([(bytes([k]),) for k in (1, 2, 250)], "k binary"), "k", 1)
    assert snap.jdbc_predicates(plan, "k", binary="X'{}'") == ["(k < X'02' OR k IS NULL)", "(k >= X'02' AND k < X'FA')", "k >= X'FA'"]
    assert snap.sql_literal(True) == "1" and snap.sql_literal(1.5) == "1.5" and snap.sql_literal("o'x") == "'o''x'"
