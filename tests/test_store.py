import pytest
from pyspark.sql import functions as F

from rowtide.operators import changes as ch
from rowtide.session import child_folders, folder_bytes, workspace
from rowtide.sources import sinks
from rowtide.sources import snapshot as snap
from rowtide.sources.merge_store import KeyedTable
from rowtide.sources.table_set import TableSet, TableSpec, tagged, tagged_union
from tests.test_changes import BASE, FEED, FINAL, base, feed


@pytest.fixture
def target(spark):
    schema = base(spark, BASE).schema
    return KeyedTable(spark, workspace(spark, "t"), ["id"], schema, buckets=4)


def test_load_apply_compact(spark, rows, target):
    target.load(base(spark, BASE))
    assert rows(target.read()) == BASE
    target.apply(feed(spark, FEED[:5]), 0)
    target.apply(feed(spark, FEED[5:]), 1)
    assert rows(target.read()) == FINAL
    assert target.compact() > 0
    assert rows(target.read()) == FINAL
    assert target.compact() == 0
    assert target.store.committed_batches() == [0, 1]


def test_without_a_snapshot(spark, rows, target):
    target.apply(feed(spark, FEED), 7)
    assert rows(target.read()) == [r for r in FINAL if r[0] != 6]


def test_replay_changes_nothing(spark, rows, target):
    target.load(base(spark, BASE))
    for k, part in [(0, FEED[:4]), (1, FEED[4:]), (1, FEED[4:]), (0, FEED[:4])]:
        target.apply(feed(spark, part), k)
    assert rows(target.read()) == FINAL
    target.compact()
    target.apply(feed(spark, FEED[4:]), 1)  # replayed after it was folded in
    assert rows(target.read()) == FINAL


def test_late_change_does_not_bring_a_deleted_row_back(spark, rows, target):
    target.load(base(spark, BASE))
    target.apply(feed(spark, [(2, "gone", 0, "d", 50), (3, "new", 1, "u", 50)]), 0)
    target.compact()
    target.apply(feed(spark, [(2, "late", 0, "u", 40), (3, "late", 1, "u", 40)]), 1)
    expected = [(3, "new", 1), (5, "old", 0), (6, "old", None)]
    assert rows(target.read()) == expected
    target.compact()
    assert rows(target.read()) == expected
    target.store.purge_tombstones(before_seq=60)
    assert rows(target.read()) == expected
    assert target.state().where("op = 'd'").count() == 0


def test_delta_without_commit_is_not_read(spark, rows, target):
    target.load(base(spark, BASE))
    stray = target._placed(feed(spark, FEED))
    target.store._write_parts(stray, f"{target.store.root}/delta/1-0-0-stray")
    assert rows(target.read()) == BASE


def test_earlier_batches_can_be_read(spark, rows, target):
    target.load(base(spark, BASE))
    target.apply(feed(spark, [(6, "one", 1, "u", 1)]), 0)
    target.apply(feed(spark, [(6, "two", 2, "u", 2)]), 1)
    assert rows(target.read(upto=0).where("id = 6")) == [(6, "one", 1)]


def test_only_touched_buckets_are_rewritten(spark, target):
    target.load(spark.range(100).select(F.col("id").cast("int"), F.lit("x").alias("v"), F.lit(1).alias("n")))
    target.apply(feed(spark, [(6, "two", 2, "u", 2)]), 0)
    assert target.compact() == 1
    versions = target.store._manifest().parts.values()
    assert sorted(versions) == [0, 0, 0, 1]


def test_vacuum_keeps_what_is_read(spark, rows, target):
    target.load(base(spark, BASE))
    for k in range(4):
        target.apply(feed(spark, [(6, f"v{k}", k, "u", 10 + k)]), k)
        target.compact()
    target.apply(feed(spark, [(5, "open", 1, "u", 99)]), 4)
    expected = [(2, "old", 0), (3, "old", 0), (5, "open", 1), (6, "v3", 3)]
    assert target.vacuum(keep=1) > 0
    assert rows(target.read()) == expected
    assert target.store.committed_batches() == [4]
    assert target.vacuum(keep=1) == 0
    target.compact()
    assert rows(target.read()) == expected


def test_new_checkpoint_after_a_compaction(spark, rows, target):
    """Batch numbers that start over are new deltas, not folded ones."""
    target.load(base(spark, BASE))
    target.apply(feed(spark, FEED[:4]), 0)
    target.apply(feed(spark, FEED[4:]), 1)
    target.compact()
    target.apply(feed(spark, [(77, "late", 1, "c", 500)]), 0)
    expected = sorted([*FINAL, (77, "late", 1)], key=repr)
    assert rows(target.read()) == expected
    target.compact()
    target.vacuum(keep=1)
    assert rows(target.read()) == expected


def test_reload_then_replay(spark, rows, target):
    """A snapshot starts over: earlier changes are gone, and batches from 0 on are taken."""
    target.load(base(spark, BASE))
    target.apply(feed(spark, [(5, "before", 9, "u", 900)]), 0)
    target.apply(feed(spark, [(6, "before", 9, "u", 900)]), 1)
    target.load(base(spark, BASE))
    assert rows(target.read()) == BASE
    target.apply(feed(spark, FEED[:4]), 0)
    target.apply(feed(spark, FEED[4:]), 1)
    assert rows(target.read()) == FINAL
    assert target.vacuum(keep=1) > 0
    assert rows(target.read()) == FINAL


def test_reader_during_a_replay(spark, rows, target):
    """A second attempt writes beside the first, which stays whole until the new mark is there."""
    target.load(base(spark, BASE))
    target.apply(feed(spark, FEED), 0)
    before = target.read()
    half = target._placed(feed(spark, FEED[:1]))
    target.store._write_parts(half, f"{target.store.root}/delta/1-0-second")
    assert rows(before) == FINAL and rows(target.read()) == FINAL


def test_null_keys_and_map_payloads(spark, rows):
    schema = "id int, m map<string,int>"
    frame = spark.createDataFrame([(None, {"a": 1}), (1, {"b": 2})], schema)
    t = KeyedTable(spark, workspace(spark, "t"), ["id"], frame.schema, buckets=2)
    t.load(frame)
    new = spark.createDataFrame([(None, {"a": 5}, "u", 1), (None, {"z": 0}, "u", 1), (1, None, "d", 3)], schema + ", op string, seq bigint")
    t.apply(new, 0)
    found = rows(t.read())
    assert len(found) == 1 and found[0][0] is None and found[0][1] in ({"a": 5}, {"z": 0})
    t.compact()
    assert rows(t.read()) == found


def test_types_survive_a_set(spark, rows):
    from datetime import date, datetime
    from decimal import Decimal

    schema = "`a key` bigint, d decimal(19,4), t timestamp_ntz, day date, raw binary, f double, n int, m map<string,int>, l array<string>, s struct<x:string>, b boolean"
    values = [(1, Decimal("12.5000"), datetime(2024, 1, 2, 3, 4, 5, 678901), date(1969, 1, 1), b"\x00\xff", float("inf"), None, {"k": 1}, ["a", None], ("é",), True), (2, *[None] * 10)]
    frame = spark.createDataFrame(values, schema)
    tables = TableSet(spark, workspace(spark, "set"), {"a": TableSpec(["a key"], frame.schema)}, 2)
    tables.load({"a": frame})
    assert tables.read("a").schema == frame.schema
    assert rows(tables.read("a")) == rows(frame)


def test_unknown_tables_are_not_dropped(spark):
    a = base(spark, BASE)
    tables = TableSet(spark, workspace(spark, "set"), {"a": TableSpec(["id"], a.schema)}, 2)
    odd = tagged(feed(spark, FEED[:2]), "a", a.columns).unionByName(tagged(feed(spark, FEED[2:3]), "a", a.columns).withColumn("table_name", F.lit("typo")))
    with pytest.raises(Exception, match="typo"):
        tables.apply(odd, 0)
    known, other = tables.known_rows(odd.unionByName(odd.limit(1).withColumn("table_name", F.lit(None).cast("string"))))
    assert (known.count(), other.count()) == (2, 2)


def test_merge_join_of_a_large_delta(spark, rows, target):
    """Beyond the broadcast limit the same result comes from a shuffled join."""
    target.load(base(spark, BASE))
    target.apply(feed(spark, FEED[:6]), 0)
    target.apply(feed(spark, FEED[6:]), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(target.read()) == FINAL
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_of_one_set_share_batches(spark, rows):
    a = base(spark, BASE)
    b = spark.createDataFrame([("x", 1, 1.5), ("y", 2, 2.5)], "k string, v int, w double")
    specs = {"a": TableSpec(["id"], a.schema), "b": TableSpec(["k", "v"], b.schema)}
    tables = TableSet(spark, workspace(spark, "set"), specs, buckets=2)
    tables.load({"a": a, "b": b})
    changed = spark.createDataFrame([("x", 1, 9.0, "u", 5), ("y", 2, 0.0, "d", 5), ("z", 1, 1.0, "c", 5)], "k string, v int, w double, op string, seq bigint")
    both = tagged_union([tagged(feed(spark, FEED), "a", a.columns), tagged(changed, "b", b.columns)])
    tables.apply(both, 0)
    for _ in range(2):
        assert rows(tables.read("a")) == FINAL
        assert rows(tables.read("b")) == [("x", 1, 9.0), ("z", 1, 1.0)]
        tables.compact()


def test_set_may_start_with_some_tables_empty(spark, rows):
    a = base(spark, BASE)
    tables = TableSet(spark, workspace(spark, "set"), {"a": TableSpec(["id"], a.schema), "b": TableSpec(["id"], a.schema)}, 2)
    tables.load({"a": a})
    tables.apply(tagged(feed(spark, FEED), "b", a.columns).withColumn("a", F.lit(None).cast(a.schema)), 0)
    assert rows(tables.read("a")) == BASE
    assert rows(tables.read("b")) == [r for r in FINAL if r[0] != 6]


def test_chunks_cover_the_table_once(spark):
    df = spark.createDataFrame([(k,) for k in (5, 6, 14, 15, 99)], "k bigint")
    plan = {r.chunk_id: (r.lo, r.hi, r.n_rows) for r in snap.chunk_plan(df, "k", 10).collect()}
    assert plan == {0: (5, 14, 3), 1: (15, 15, 1), 9: (99, 99, 1)}
    parts = [snap.read_chunks(df, "k", 5, c, c, 10) for c in range(10)]
    assert sorted(r.k for p in parts for r in p.collect()) == [5, 6, 14, 15, 99]
    assert snap.chunk_plan(df.limit(0), "k").count() == 0


def test_chunks_of_text_keys(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a", "c'd", "é", "a", None, "z"]], "k string")
    plan = snap.key_chunk_plan(df, "k", 2)
    assert {r.chunk_id: (r.lo, r.hi, r.n_rows) for r in plan.collect()} == {0: ("a", "a", 3), 1: ("b", "c'd", 2), 2: ("z", "é", 2)}
    assert {r.k: r.chunk_id for r in snap.key_chunked_snapshot(df, "k", 2).collect()} == {None: 0, "a": 0, "b": 1, "c'd": 1, "z": 2, "é": 2}
    conditions = snap.jdbc_predicates(plan, "k")
    assert conditions == ["(k < 'b' OR k IS NULL)", "(k >= 'b' AND k < 'z')", "k >= 'z'"]
    assert sum(df.where(c).count() for c in conditions) == 7


def test_jdbc_options_split_the_key_range(spark):
    options = snap.jdbc_chunk_options({"url": "jdbc:x"}, "k", (5, 1_000_004), size=10_000)
    assert options == {
        "url": "jdbc:x",
        "partitionColumn": "k",
        "lowerBound": "5",
        "upperBound": "1000005",
        "numPartitions": "20",
        "fetchsize": "1024",
    }
    assert snap.jdbc_chunk_options({}, "k", (1, 10))["numPartitions"] == "1"


def test_sinks(spark, rows):
    b = base(spark, BASE)
    path = workspace(spark, "b")
    sinks.write_bucketed(b, path, ["id"], 3)
    back = spark.read.parquet(path)
    assert rows(back, "id", "v", "n") == BASE
    assert back.select("bucket").distinct().count() <= 3
    path = workspace(spark, "c")
    sinks.write_catalog_version(b, path, "test", "j", 1)
    sinks.write_catalog_version(b.where("id = 2"), path, "test", "j", 2)
    sinks.write_catalog_version(b, path, "prod", "j", 3)
    assert rows(sinks.latest_catalog(spark, path, b.schema, "test", "j"), "id") == [(2,)]
    encoded = sinks.json_rows(b).collect()
    assert {r.json for r in encoded} >= {'{"id":2,"v":"old","n":0}', '{"id":6,"v":"old"}'}


def test_key_must_be_selected(spark):
    schema = base(spark, BASE).schema
    for keys in (["gone"], []):
        with pytest.raises(ValueError):
            KeyedTable(spark, workspace(spark, "t"), keys, schema)


def test_live_rows_of_latest(spark, rows):
    assert rows(ch.live_rows(ch.latest_change_per_key(feed(spark, FEED), ["id"]))) == [r for r in FINAL if r[0] != 6]


def test_unknown_columns_and_ops_are_refused(spark, rows, target):
    target.load(base(spark, BASE))
    with pytest.raises(ValueError, match="'w'"):
        target.apply(feed(spark, FEED).withColumn("w", F.lit(1)), 0)
    target.apply(feed(spark, FEED).withColumn("w", F.lit(1)), 0, ignore=["w"])
    known = rows(target.read())
    for op in (None, "D", ""):
        with pytest.raises(Exception, match="op is one of"):
            target.apply(feed(spark, [(1, "x", 1, op, 99)]), 1)
    assert rows(target.read()) == known


def test_failed_attempts_go_with_the_next_vacuum(spark, rows, target):
    target.load(base(spark, BASE))
    target.store._write_parts(target._placed(feed(spark, FEED)), f"{target.store.root}/delta/1-0-0-failed")
    target.apply(feed(spark, FEED), 0)
    before = rows(target.read())
    assert target.vacuum() == 1 and len(child_folders(spark, f"{target.store.root}/delta")) == 1
    assert rows(target.read()) == before


def test_commits_bound_a_read_whatever_their_batch_numbers(spark, rows, target):
    target.load(base(spark, BASE))
    for k, (batch, v) in enumerate([(0, "one"), (1, "two"), (0, "three")]):  # a new checkpoint counts from 0 again
        target.apply(feed(spark, [(6, v, k, "u", k + 1)]), batch)
    assert [rows(target.read(upto=k).where("id = 6"))[0][1] for k in range(3)] == ["one", "two", "three"]
    target.compact()
    with pytest.raises(ValueError):
        target.read(upto=1)
    assert rows(target.read(upto=2)) == rows(target.read())


def test_folding_costs_as_much_as_the_batches(spark, rows):
    """Ten batches over a base many times their size: few open deltas, and each row is rewritten a few times only."""
    target = KeyedTable(spark, workspace(spark, "fold"), ["id"], base(spark, BASE).schema, buckets=1)
    target.load(spark.range(40_000).select(F.col("id").cast("int"), F.col("id").cast("string").alias("v"), F.lit(1).alias("n")))
    written, one = 0, None
    for k in range(10):
        changed = spark.range(k * 100, k * 100 + 300).select(F.col("id").cast("int"), F.lit(f"b{k}").alias("v"), F.lit(2).alias("n"), F.lit("u").alias("op"), F.lit(k).cast("long").alias("seq"))
        target.apply(changed.coalesce(1), k)
        one = one or folder_bytes(spark, f"{target.store.root}/delta")
        if k % 2:
            before = {d.name for d in target.store._marks()}
            assert target.fold(share=0.9) == 0
            written += sum(folder_bytes(spark, f"{target.store.root}/delta/{d.name}") for d in target.store._marks() if d.name not in before)
    target.vacuum(keep=1)
    assert len(target.store.open_deltas()) <= 4 and written <= 3 * 10 * one
    want = {i: (str(i), 1) for i in range(40_000)} | {i: (f"b{k}", 2) for k in range(10) for i in range(k * 100, k * 100 + 300)}
    assert {r.id: (r.v, r.n) for r in target.read().collect()} == want
    assert target.fold(share=0.0) == 1 and target.store.open_deltas() == []
    assert {r.id: (r.v, r.n) for r in target.read().collect()} == want


def test_columns_are_added_and_types_widened(spark, rows):
    root = workspace(spark, "evolve")
    narrow = spark.createDataFrame([(1, 5), (2, 6)], "id int, n int")
    target = KeyedTable(spark, root, ["id"], narrow.schema, buckets=2)
    target.load(narrow)
    target.apply(spark.createDataFrame([(3, 7, "c", 1)], "id int, n int, op string, seq long"), 0)
    wide = spark.createDataFrame([(2, 2**40, "x", "u", 2)], "id int, n long, t string, op string, seq long")
    for refused in ("id long, n int", "id int", "id int, n string"):
        with pytest.raises(ValueError):
            target.change_schema(spark.createDataFrame([], refused).schema)
    target.change_schema(wide.drop("op", "seq").schema)
    target.apply(wide, 1)
    want = [(1, 5, None), (2, 2**40, "x"), (3, 7, None)]
    assert rows(target.read()) == want
    target.compact()
    again = KeyedTable(spark, root, ["id"], wide.drop("op", "seq").schema, buckets=2)
    assert rows(again.read()) == want and again.store.stored_schema().names == ["id", "n", "t", "op", "seq"]
    with pytest.raises(ValueError, match="another schema"):
        KeyedTable(spark, root, ["id"], narrow.schema, buckets=2).apply(wide.select("id", F.col("n").cast("int"), "op", "seq"), 2)


def test_sets_of_tables_refuse_types_they_cannot_keep(spark):
    for kind in ("map<int,string>", "interval day to second", "array<map<int,int>>"):
        with pytest.raises(ValueError, match="t.x"):
            TableSet(spark, workspace(spark, "set"), {"t": TableSpec(["id"], spark.createDataFrame([], f"id int, x {kind}").schema)})
