"""Ranks and plans against brute force, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators.ranking import Desc, Ranges, chunk_groups, ranked
from rowtide.plans import jobs


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.7 else rng.choice("abcdefgh"), rng.randrange(50), i) for i in range(3000)]
    return data, spark.createDataFrame(data, "g string, m int, id int").repartition(5)


def brute(data, key):
    groups = {}
    for row in sorted(data, key=key):
        groups.setdefault(row[0], []).append(row)
    return {row[2]: (n + 1, len(g)) for g in groups.values() for n, row in enumerate(g)}


def test_ranked_matches_brute_force(spark, skewed):
    data, df = skewed
    out = ranked(df, ["g"], [Desc("m"), "id"], size="n", partitions=8)
    assert {r.id: (r.rank_no, r.n) for r in out.collect()} == brute(data, lambda r: (-r[1], r[2]))


def test_ranked_over_everything(spark, skewed):
    data, df = skewed
    out = ranked(df, [], [Desc("m"), "id"], partitions=4)
    assert {r.id: r.rank_no for r in out.collect()} == {
        r[2]: n + 1 for n, r in enumerate(sorted(data, key=lambda r: (-r[1], r[2])))
    }


def test_ranked_with_null_groups_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, id int")
    out = ranked(df, ["g"], ["id"])
    assert {(r.g, r.id): r.rank_no for r in out.collect()} == {(None, 1): 1, (None, 2): 2, ("a", 1): 1}
    assert ranked(df.limit(0), ["g"], ["id"]).count() == 0


def test_chunks_have_at_most_n_rows(spark, skewed):
    data, df = skewed
    sizes = chunk_groups(df, ["g"], ["id"], 10).groupBy("g", "group_no").count().collect()
    assert max(r["count"] for r in sizes) == 10
    hot = sum(1 for r in data if r[0] == "hot")
    assert max(r.group_no for r in sizes if r.g == "hot") == -(-hot // 10)


@pytest.mark.parametrize(
    "name, domain",
    [
        ("GLNumber", "gl"),
        ("QBInvoice", "qb"),
        ("Order_Route", "order"),
        ("OrderItems", "order"),
        ("ABC", "abc"),
        ("ABC_Def", "misc"),
        ("A", "misc"),
        ("ORDERs", "orde"),
        ("orders", "misc"),
        ("", "misc"),
    ],
)
def test_domains(spark, name, domain):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(jobs.extract_domain(F.col("n")).alias("d")).first().d == domain


def test_groups_by_domain(spark):
    names = [f"Order{i:02d}" for i in range(12)] + ["GLNumber", "GLEntry", "Zebra", "Apple", "Mango"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {}
    for r in jobs.group_by_domain(df, "name", 5).collect():
        got.setdefault(r.group_name, set()).add(r.name)
    assert got == {
        "order_group1": {f"Order{i:02d}" for i in range(5)},
        "order_group2": {f"Order{i:02d}" for i in range(5, 10)},
        "order_group3": {"Order10", "Order11"},
        "gl_group1": {"GLNumber", "GLEntry"},
        "medium_misc_group1": {"Apple", "Mango", "Zebra"},
    }
    listed = jobs.group_members(jobs.group_by_domain(df, "name", 5), "name").collect()
    assert {r.group_name: r.members for r in listed}["gl_group1"] == ["GLEntry", "GLNumber"]


def activity(spark):
    rows = [("dbo", "A", "high", 90, 50, 1), ("dbo", "B", "high", 80, 40, 2), ("dbo", "C", "medium", 9, 4, 3), ("dbo", "D", "medium", 8, 3, 4), ("dbo", "E", "low", 0, 0, 5)]
    return spark.createDataFrame(rows, "s string, name string, category string, total_io bigint, total_updates bigint, row_count bigint")


def test_tier_plan(spark, rows):
    plan = jobs.plan_by_tier(activity(spark), "s", "name")
    assert rows(plan) == [
        ("dbo_A", "dbo_A_config.yaml", "high", 1, 90, 50, 1),
        ("dbo_B", "dbo_B_config.yaml", "high", 1, 80, 40, 2),
        ("dbo_low_io_bundle", "dbo_low_io_bundle_config.yaml", "bundle", 1, 0, 0, 5),
        ("dbo_medium_io_bundle", "dbo_medium_io_bundle_config.yaml", "bundle", 2, 17, 7, 7),
    ]
    members = jobs.union_tiers(activity(spark), "s", "name")
    assert members.count() == 5
    one = jobs.table_to_job(activity(spark).select("name"), members, "name").where("name = 'D'").first()
    assert one.job_name == "dbo_medium_io_bundle"


def test_balanced_plan_deals_forth_and_back(spark):
    df = spark.createDataFrame([(f"t{i}", 100 - i) for i in range(8)], "name string, total_io bigint")
    got = [r.job_no for r in jobs.balanced_plan(df, "name", 3).orderBy("activity_rank").collect()]
    assert got == [1, 2, 3, 3, 2, 1, 1, 2]


def test_dense_ranks_share_a_number(spark, skewed):
    data, df = skewed
    out = ranked(df, ["g"], [Desc("m")], dense=True, partitions=8)
    levels = {}
    for g, m, _ in data:
        levels.setdefault(g, set()).add(m)
    assert {(r.g, r.m, r.rank_no) for r in out.collect()} == {(g, m, 1 + sum(x > m for x in ms)) for g, ms in levels.items() for m in ms}


@pytest.mark.parametrize("order", [["x", "id"], [Desc("x"), Desc("id")]])
def test_ranges_keep_the_order_with_nulls_and_nan(spark, order):
    rng = random.Random(1)
    values = [None, float("nan"), -0.0, 0.0, 1.5, -2.0]
    df = spark.createDataFrame([(rng.choice(values), rng.choice("ab") if i % 9 else None, i) for i in range(900)], "x double, g string, id int")
    ranges = Ranges(df, ["g"], order, partitions=9)
    rows = ranges.keys.sort(F.asc_nulls_first("g"), *[F.desc_nulls_last(o.column) if isinstance(o, Desc) else F.asc_nulls_first(o) for o in order]).collect()
    numbers = [r[-1] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) == 9
    place = {}
    for r in rows:
        place.setdefault(r.g, []).append(r.id)
    want = {i: (n + 1, len(ids)) for ids in place.values() for n, i in enumerate(ids)}
    assert {r.id: (r.rank_no, r.n) for r in ranked(df, ["g"], order, size="n", partitions=9).collect()} == want


def test_many_small_groups_and_names_of_its_own(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("_n"), F.col("id").alias("_size"))
    got = ranked(df, ["_n"], ["_size"], rank="_before", size="_inside", partitions=16).collect()
    assert {(r._n, r._size): (r._before, r._inside) for r in got} == {(i % 1000, i): (i // 1000 + 1, 3) for i in range(3000)}


def test_only_keys_are_kept(spark):
    wide = spark.range(100).select("id", *[F.lit("x" * 50).alias(f"c{k}") for k in range(9)])
    assert Ranges(wide, [], ["id"]).keys.columns == ["id", "_rk_range"]


def heaviest(df, jobs_n):
    loads = [0] * jobs_n
    for r in df.collect():
        assert 1 <= r.job_no <= jobs_n
        loads[r.job_no - 1] += max(0, r.total_io or 0)
    return max(loads)


def least_possible(amounts, jobs_n):
    best = sum(amounts)
    seen = {tuple([0] * jobs_n)}
    for a in sorted(amounts, reverse=True):
        seen = {tuple(sorted(s[:i] + (s[i] + a,) + s[i + 1 :])) for s in seen for i in range(jobs_n)}
    return min(best, min(max(s) for s in seen))


@pytest.mark.parametrize("seed", range(3))
def test_heaviest_job_is_at_most_four_thirds_of_the_least(spark, seed):
    rng = random.Random(seed)
    amounts = [rng.choice([rng.randrange(100), rng.randrange(10), 0]) for _ in range(9)]
    df = spark.createDataFrame([(f"t{i}", a) for i, a in enumerate(amounts)] + [(None, None), ("neg", -5)], "name string, total_io bigint")
    got = jobs.balanced_by_amount(df, "name", 3)
    assert got.count() == len(amounts) + 2 and 3 * heaviest(got, 3) <= 4 * least_possible(amounts, 3)


def test_the_tail_fills_the_jobs_to_one_level(spark):
    rng = random.Random(2)
    rows = [(f"t{i:04d}", rng.randrange(50)) for i in range(2000)] + [("a", 9000), ("b", 300), ("c", 200)]
    df = spark.createDataFrame(rows, "name string, total_io bigint").repartition(5)
    got = jobs.balanced_by_amount(df, "name", 5, head=12)
    assert sorted((r.name, r.total_io) for r in got.collect()) == sorted(rows)
    level = max(9000, -(-sum(a for _, a in rows) // 5))
    assert heaviest(got, 5) <= level + 50
    even = jobs.balanced_by_amount(df.where("total_io < 100"), "name", 5, head=12)
    assert heaviest(even, 5) <= -(-sum(a for _, a in rows if a < 100) // 5) + 50
    assert jobs.balanced_by_amount(df.limit(0), "name", 5).count() == 0


def test_bounds_of_long_texts_leave_the_plan_small(spark):
    data = [(i % 3, ("same " * 500 if i % 2 else f"{i % 17} ") + f"long {i * 7919 % 400} " + "x" * 4000) for i in range(400)]
    df = spark.createDataFrame(data, "g long, t string").repartition(5)
    got = ranked(df, ["g"], ["t"], partitions=40)
    assert len(got._jdf.queryExecution().toString()) < 400_000
    want = {(g, t): n for k in range(3) for n, (g, t) in enumerate(sorted(r for r in data if r[0] == k), 1)}
    assert {(r.g, r.t): r.rank_no for r in got.collect()} == want
