from datetime import datetime

from rowtide.operators import activity as act

OPS = "entity string, index_id int, range_scan_count bigint, singleton_lookup_count bigint, leaf_insert_count bigint, leaf_update_count bigint, leaf_delete_count bigint, row_lock_count bigint, page_lock_count bigint"
PARTS = "entity string, index_id int, partition_no int, row_count bigint, used_page_count bigint, reserved_page_count bigint"
USAGE = "entity string, user_seeks bigint, user_scans bigint, user_lookups bigint, user_updates bigint, last_user_seek timestamp_ntz, last_user_scan timestamp_ntz, last_user_update timestamp_ntz"


def names(spark, *n):
    return spark.createDataFrame([(x,) for x in n], "entity string")


def test_partitions_do_not_multiply_counters(spark):
    ops = spark.createDataFrame([("a", 1, 10, 5, 1, 2, 3, 15, 4), ("a", 1, 1, 1, 1, 0, 0, 0, 0), ("a", 5, 99, 99, 99, 0, 0, 0, 0)], OPS)
    parts = spark.createDataFrame([("a", 1, p, 100, 2, 3) for p in range(4)] + [("a", 3, 0, 7, 7, 7)], PARTS)
    row = act.three_way_stats(ops, parts, names(spark, "a", "b"), "entity").collect()
    assert len(row) == 1
    r = row[0]
    assert (r.total_reads, r.total_updates, r.locks, r.total_io) == (17, 7, 19, 25)
    assert (r.row_count, r.used_kb, r.reserved_kb) == (400, 64, 96)


def usage(spark):
    t = datetime(2024, 1, 1), datetime(2024, 2, 1)
    return spark.createDataFrame(
        [("a", 5, 1, 0, 0, t[0], None, None), ("a", 0, 0, 2, 0, None, t[1], None), ("b", 0, 0, 0, 0, None, None, None), ("c", 8, 0, 0, 4, t[0], None, t[1])],
        USAGE,
    )


def test_full_coverage(spark):
    rolled = act.activity_rollup(usage(spark), "entity")
    counts = spark.createDataFrame([("a", 3)], "entity string, row_count bigint")
    out = act.full_coverage(names(spark, "a", "b", "c", "d"), rolled, "entity", counts, high=4, low=0)
    got = {r.entity: r for r in out.collect()}
    assert (got["a"].total_reads, got["a"].read_write_ratio, got["a"].row_count) == (8, 999999.0, 3)
    assert got["a"].last_activity == datetime(2024, 2, 1)
    assert (got["b"].read_write_ratio, got["b"].category, got["b"].last_activity) == (0.0, "medium", None)
    assert (got["c"].read_write_ratio, got["c"].category) == (2.0, "high")
    assert (got["d"].total_io, got["d"].row_count, got["d"].category) == (0, 0, "low")
    summary = {r.tier: r.n_entities for r in act.tier_summary(out).collect()}
    assert summary == {"total": 4, "high": 1, "medium": 2, "low": 1}
    empty = {r.tier: r.n_entities for r in act.tier_summary(out.limit(0)).collect()}
    assert empty == {"total": 0, "high": 0, "medium": 0, "low": 0}


def test_row_estimates_and_missing_bases(spark):
    partitions = spark.createDataFrame([("a", 0, 30), ("a", 1, 12), ("b", 2, 9)], "entity string, index_id int, rows bigint")
    counts = act.row_counts_of_all(names(spark, "a", "b"), partitions, "entity")
    assert {r.entity: r.row_count for r in counts.collect()} == {"a": 42, "b": None}
    got = {r.entity: r for r in act.estimate_from_rows(counts, 400, 1).collect()}
    assert (got["a"].total_io, got["a"].total_updates, got["a"].read_write_ratio, got["a"].category) == (420, 0, 0.0, "high")
    assert (got["b"].total_io, got["b"].category) == (0, "low")


def test_fallback_takes_the_best_source(spark):
    rolled = act.activity_rollup(usage(spark), "entity").where("entity = 'c'")
    ops = act.with_lock_weight(act.operational_rollup(spark.createDataFrame([("c", 1, 9, 9, 9, 9, 9, 9, 9), ("d", 0, 6, 0, 3, 0, 0, 10, 0)], OPS), "entity"))
    counts = spark.createDataFrame([("c", 1), ("e", 50)], "entity string, row_count bigint")
    out = act.fallback_chain(names(spark, "c", "d", "e", "f"), rolled, ops, counts, "entity", high=100, low=3)
    got = {r.entity: (r.stat_source, r.total_io, r.total_updates, r.read_write_ratio, r.category, r.row_count) for r in out.collect()}
    assert got == {
        "c": ("usage", 12, 4, 2.0, "medium", 1),
        "d": ("operational", 10, 3, 2.0, "medium", 0),
        "e": ("rows", 500, 0, 0.0, "high", 50),
        "f": ("none", 0, 0, 0.0, "low", 0),
    }


def test_report_keeps_entities_as_rows(spark):
    rolled = act.activity_rollup(usage(spark), "entity")
    covered = act.full_coverage(names(spark, "a", "b", "c"), rolled, "entity", high=4, low=1)
    jobs = spark.createDataFrame([("c", "job_c")], "entity string, job_name string")
    report = act.activity_report(covered, "entity", 4, 1, jobs).collect()
    tables = {r.name: r.entry for r in report if r.section == "table"}
    assert set(tables) == {"a", "b", "c"} and tables["c"].job_name == "job_c" and tables["a"].job_name is None
    assert {r.name: r.value for r in report if r.section == "threshold"} == {"high": 4, "low": 1}
    assert {r.name: r.value for r in report if r.section == "summary"}["total"] == 3


def test_top_is_settled_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "entity string, total_updates bigint")
    assert [r.entity for r in act.top_hot(df, 3, "entity").collect()] == ["c", "a", "b"]
