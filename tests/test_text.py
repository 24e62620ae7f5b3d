from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowtide.functions import text
from rowtide.functions.measures import latest_of, lock_weighted_io, read_write_ratio, safe_number, tier
from rowtide.operators import selection as sel

NAMES = ["Orders", "orders", "OrderItems", "Order.Items", "tmp_x", "Orders_Archive", "a+b", "a\nb", None]


def matched(spark, column):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    return {r.n for r in df.where(column).collect()}


@pytest.mark.parametrize(
    "patterns, expected",
    [
        (["ORDERS"], {"Orders", "orders"}),
        (["order?"], {"Orders", "orders"}),
        (["Order*"], {"Orders", "orders", "OrderItems", "Order.Items", "Orders_Archive"}),
        (["order.items"], {"Order.Items"}),
        (["order.*"], {"Order.Items"}),
        (["^Order.*"], set()),
        (["*_archive", "a+?"], {"Orders_Archive", "a+b"}),
        (["a*b"], {"a+b"}),
        ([], set(NAMES)),
    ],
)
def test_globs_are_anchored_literal_and_ignore_case(spark, patterns, expected):
    assert matched(spark, text.glob_match(F.col("n"), patterns)) == expected
    plain = [n for n in NAMES if n]
    assert {n for n in plain if text.name_selected(n, patterns)} == expected - {None}


def test_regex_mode_searches(spark):
    assert matched(spark, text.regex_match(F.col("n"), ["^order.*s$", "_ARCH"])) == {
        "Orders",
        "orders",
        "OrderItems",
        "Order.Items",
        "Orders_Archive",
    }


def test_exclusion_wins_and_empty_include_keeps(spark):
    keep = text.selected(F.col("n"), include=["Order*"], exclude=["*_Archive"])
    assert matched(spark, keep) == {"Orders", "orders", "OrderItems", "Order.Items"}
    assert "tmp_x" not in matched(spark, text.selected(F.col("n"), exclude=["tmp_*"]))
    assert None in matched(spark, text.selected(F.col("n"), exclude=["tmp_*"]))


def test_system_names(spark, rows):
    names = ["sysdiagrams", "SYSfoo", "MSlog", "mslog", "dtprops", "trace_1", "traceX", "trace", "Orders"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n for r in sel.without_system_names(df, "n").collect()} == {"SYSfoo", "mslog", "trace", "Orders"}
    assert {r.n for r in sel.without_system_names(df, "n", False).collect()} == {"trace", "Orders"}


def test_list_filters(spark):
    df = spark.createDataFrame([("A",), ("b",), ("C*",), (None,)], "n string")
    names = spark.createDataFrame([("a",), ("B",)], "x string")
    assert sel.in_list(df, "n", []).count() == 0
    assert {r.n for r in sel.in_list(df, "n", ["A", "x"]).collect()} == {"A"}
    assert {r.n for r in sel.exclude_list(df, "n", ["a", "c*"]).collect()} == {"b", None}
    assert {r.n for r in sel.exclude_list(df, "n", ["?"], mode="glob").collect()} == {"C*", None}
    assert {r.n for r in sel.exclude_list(df, "n", names).collect()} == {"C*", None}
    assert sel.exclude_list(df, "n", []).count() == 4


def test_column_projection(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Id int, SSN int, Email int, Debug int")
    assert sel.project_columns(df, exclude=["ssn", "DE*"]).columns == ["Id", "Email"]
    assert sel.project_override(df, ["Debug"], ["Debug", "Id", "ssn"]).columns == ["Id"]
    assert sel.project_override(df, ["id"]).columns == df.columns
    assert sel.key_first(df, ["Email", "SSN"]).columns == ["SSN", "Email", "Id", "Debug"]
    with pytest.raises(ValueError):
        sel.key_first(df, ["Gone"])
    assert sel.sensitive_projection(df, ["SSN"], ["Id", "Email"]).columns == ["Id", "Email"]
    with pytest.raises(ValueError):
        sel.sensitive_projection(df, ["ssn"], ["Id", "SSN"])
    assert sel.drop_derived(sel.mark_derived(df, ["Debug"])).columns == ["Id", "SSN", "Email"]


def test_measures(spark):
    df = spark.createDataFrame([(5, 0, 19), (0, 0, 20), (9, 6, 0)], "r bigint, w bigint, l bigint")
    out = df.select(
        read_write_ratio(F.col("r"), F.col("w")).alias("ratio"),
        lock_weighted_io(F.col("r"), F.col("w"), F.col("l")).alias("io"),
        tier(F.col("r"), 9, 5).alias("t"),
    ).collect()
    assert [tuple(r) for r in out] == [(999999.0, 6, "medium"), (0.0, 2, "low"), (1.5, 15, "high")]


def test_times_and_numbers(spark):
    late, soon = datetime(2024, 5, 6, 7, 8, 9, 120000), datetime(2024, 1, 1)
    df = spark.createDataFrame([(soon, None, late, "12", 1234567)], "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz, s string, n bigint")
    row = df.select(
        text.iso_millis(F.col("c")).alias("c"),
        text.iso_millis(F.col("a")).alias("a"),
        latest_of(F.col("a"), F.col("b"), F.col("c")).alias("latest"),
        safe_number(F.col("s")).alias("s"),
        safe_number(F.lit("x1")).alias("x"),
        text.grouped_number(F.col("n")).alias("n"),
        text.fixed2(F.lit(1.125)).alias("f"),
        text.identifier(F.lit("sales-db-1")).alias("i"),
    ).first()
    assert tuple(row) == ("2024-05-06T07:08:09.120Z", "2024-01-01T00:00:00.000Z", late, 12, 0, "1,234,567", "1.13", "sales_db_1")


def test_case_of_any_alphabet(spark):
    from rowtide.functions.text import name_selected, regex_match

    df = spark.createDataFrame([("ÉTAT",)], "n string")
    assert df.select(regex_match(F.col("n"), ["^état"])).first()[0] and name_selected("ÉTAT", ["^état"], [], "regex")
