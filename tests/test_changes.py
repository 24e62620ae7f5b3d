import random
import re

import pytest
from pyspark.sql import functions as F

from rowtide.operators import changes as ch
from rowtide.operators import diff

SCHEMA = "id int, v string, n int, op string, seq bigint"


def feed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, n int")


FEED = [
    (1, "a", 1, "c", 10),
    (1, "b", None, "u", 20),
    (2, None, 5, "u", 11),
    (2, "z", 9, "d", 12),
    (3, "q", 1, "d", 5),
    (3, "r", 2, "c", 6),
    (4, "s", 2, "u", 7),
    (4, "t", 2, "d", 7),  # equal seq: the delete is last
    (5, "x", 1, "u", 3),
    (5, "y", 1, "u", 3),  # equal seq and op: the payload decides
]
BASE = [(2, "old", 0), (3, "old", 0), (5, "old", 0), (6, "old", None)]
FINAL = [(1, "b", None), (3, "r", 2), (5, "y", 1), (6, "old", None)]


def test_apply(spark, rows):
    assert rows(ch.apply_changes(base(spark, BASE), feed(spark, FEED), ["id"])) == FINAL


def test_single_kinds(spark, rows):
    b, f = base(spark, BASE), feed(spark, FEED)
    assert rows(ch.apply_inserts(b, f, ["id"])) == sorted([*BASE, (1, "b", None)], key=repr)
    assert rows(ch.apply_updates(b, f, ["id"])) == [(2, "old", 0), (3, "r", 2), (5, "y", 1), (6, "old", None)]
    assert rows(ch.apply_deletes(b, f, ["id"])) == [(3, "old", 0), (5, "old", 0), (6, "old", None)]


@pytest.mark.parametrize("seed", range(3))
def test_any_order_and_split_gives_the_same_state(spark, rows, seed):
    mixed = FEED[:]
    random.Random(seed).shuffle(mixed)
    cut = 1 + seed * 3
    state = ch.as_state(base(spark, BASE))
    for part in (mixed[:cut], mixed[cut:], mixed[:cut]):
        state = ch.merge_state(state, feed(spark, part), ["id"])
    assert rows(ch.live_rows(state)) == FINAL


def test_snapshot_then_changes_drops_what_the_snapshot_holds(spark, rows):
    both = ch.snapshot_then_changes(base(spark, BASE), feed(spark, FEED), 10)
    assert sorted(r.seq for r in both.where("op <> 'r'").collect()) == [11, 12, 20]
    assert both.where("op = 'r' and seq = 10").count() == 4


def test_diff_round_trip(spark, rows):
    old, new = base(spark, BASE), base(spark, FINAL)
    kinds = dict(rows(diff.snapshot_diff(old, new, ["id"])))
    assert kinds == {1: "+", 2: "-", 3: "~", 5: "~", 6: "="}
    assert rows(ch.apply_changes(old, diff.diff_to_change_feed(old, new, ["id"], 1), ["id"])) == FINAL
    cells = rows(diff.column_level_diff(old, new, ["id"]))
    assert cells == [(3, "n", "0", "2"), (3, "v", "old", "r"), (5, "n", "0", "1"), (5, "v", "old", "y")]
    assert rows(ch.reconcile_rows(old, new, ["id"])) == [(1, "extra"), (2, "missing"), (3, "different"), (5, "different")]


def test_null_values_are_compared_as_values(spark, rows):
    old, new = base(spark, [(1, None, 1), (2, None, None)]), base(spark, [(1, "x", 1), (2, None, None)])
    assert dict(rows(diff.snapshot_diff(old, new, ["id"]))) == {1: "~", 2: "="}
    assert rows(diff.column_level_diff(old, new, ["id"])) == [(1, "v", None, "x")]


def test_row_digest_is_unambiguous(spark, rows):
    a = spark.createDataFrame([(1, "a|", "b"), (2, None, "-"), (3, "", None)], "id int, x string, y string")
    b = spark.createDataFrame([(1, "a", "|b"), (2, "-", None), (3, None, "")], "id int, x string, y string")
    assert [s for _, s in rows(ch.reconcile_rows(a, b, ["id"]))] == ["different"] * 3


def test_reconcile_counts_covers_missing_tables(spark, rows):
    b = base(spark, BASE)
    got = rows(ch.reconcile_counts({"a": b, "b": b}, {"a": b.where("id > 2")}))
    assert got == [("a", 4, 3, -1, False), ("b", 4, 0, -4, False)]


def test_with_computed(spark, rows):
    df = ch.with_computed(base(spark, [(1, "x", 4)]), {"twice": "n * 2", "tag": "concat(v, '-', id)"})
    assert rows(df) == [(1, "x", 4, 8, "x-1")]


def test_digests_of_nested_values(spark):
    from rowtide.functions.digests import digest_of

    kinds = "a array<string>, m map<string,int>, s struct<x:string,y:array<int>>"
    values = [
        (["null"], {"a": 1, "b": 2}, ("1", [1])), ([None], {"a": 1, "b": 2}, ("1", [1])), (["a", "b"], {}, ("1", [1])), (["a, b"], {}, ("1", [1])),
        ([], None, None), (None, None, None), (None, None, (None, None)), (["1:a"], {"a": None}, ("1", [])), (["a"], {"a": None}, ("1", None)),
    ]
    df = spark.createDataFrame(values, kinds)
    assert df.select(digest_of(df, df.columns)).distinct().count() == len(values)
    turned = spark.createDataFrame([(["null"], {"b": 2, "a": 1}, ("1", [1]))], kinds)
    assert turned.select(digest_of(turned, turned.columns)).first() == df.limit(1).select(digest_of(df, df.columns)).first()


def test_null_and_unknown_ops_are_refused(spark, rows):
    base = spark.createDataFrame([(1, "a")], "id int, v string")
    for op in (None, "D"):
        feed = spark.createDataFrame([(1, "b", op, 1)], "id int, v string, op string, seq long")
        with pytest.raises(Exception, match="op is one of"):
            ch.apply_changes(base, feed, ["id"]).collect()
        known, other = ch.known_ops(feed)
        assert known.count() == 0 and other.count() == 1


def test_tree_finds_what_the_full_comparison_finds(spark, rows):
    rng = random.Random(5)
    data = [(i, rng.choice(["x", None]), float(rng.randrange(3))) for i in range(500)] + [(None, "n", 0.0)]
    left = spark.createDataFrame(data, "id int, v string, f double")
    changed = [(i, v, -f if f == 0 else f) for i, v, f in data if i not in (3, 77)]
    changed[10] = (changed[10][0], "other", 1.0)
    right = spark.createDataFrame([*changed, (9999, "new", 0.0)], left.schema)
    found = rows(ch.reconcile_tree(left, right, ["id"], bits=6))
    assert found == rows(ch.reconcile_rows(left, right, ["id"])) and len(found) == 4
    assert ch.reconcile_tree(left, left, ["id"]).count() == 0
    assert rows(ch.reconcile_tree(left.limit(0), left.limit(3), ["id"])) == rows(ch.reconcile_rows(left.limit(0), left.limit(3), ["id"]))


def test_tree_shuffles_rows_of_differing_ranges_only(spark):
    left = spark.range(20_000).select("id", F.col("id").cast("string").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77, "changed").otherwise(F.col("v")))
    found = ch.reconcile_tree(left, right, ["id"], bits=10)
    assert [tuple(r) for r in found.collect()] == [(77, "different")]
    node = found._jdf.queryExecution().executedPlan()
    written = [int(x) for x in re.findall(r"shuffle records written=(\d+)", shuffle_metrics(node))]
    assert written and sum(written) < 200


def shuffle_metrics(plan) -> str:
    """The final plan's shuffles with the records they wrote."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            out.append(f"shuffle records written={node.metrics().apply('shuffleRecordsWritten').value()}")
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return " ".join(out)


@pytest.mark.parametrize("seed", range(2))
def test_latest_by_hash_is_the_latest(spark, rows, seed):
    rng = random.Random(seed)
    big = [None, -(2**63), 2**63 - 1, 0, 1]
    data = [(rng.choice([None, *range(8)]), rng.choice(["x", "y", None]), rng.randrange(3), rng.choice("rcud"), rng.choice(big)) for _ in range(300)]
    changes = feed(spark, data)
    assert rows(ch.latest_change_by_hash(changes, ["id"])) == rows(ch.latest_change_per_key(changes, ["id"]))
    assert ch.latest_change_by_hash(changes.limit(0), ["id"]).count() == 0


def test_latest_by_hash_does_not_sort_the_feed(spark, capsys):
    ch.latest_change_by_hash(feed(spark, FEED), ["id"]).explain()
    plan = capsys.readouterr().out
    assert re.search(r"HashAggregate\(keys=\[id#\d+\], functions=\[partial_max\(_place", plan)
