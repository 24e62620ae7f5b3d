import pytest

from rowtide.functions.conversions import ColumnSpec
from rowtide.plans.replication import JobRule, TableRule, job_feed, load_job, prepared
from rowtide.session import workspace
from rowtide.streaming import feeds

ORDERS = "SSN string, Total string, OrderId int, Debug int, Twice int"
RULE = JobRule(
    tables={"Orders": TableRule(["OrderId"], exclude_columns=["Debug"], derived=["Twice"], specs=[ColumnSpec("Total", "money")])},
    include_tables=["order*"],
    exclude_tables=["*_archive"],
    exclude_columns=["ssn"],
)


def test_job_selects_converts_and_applies(spark, rows):
    snapshot = spark.createDataFrame([("s", "1.5", 1, 0, 3), ("s", "x", 2, 0, 0)], ORDERS)
    other = spark.createDataFrame([(1,)], "id int")
    target = load_job(spark, workspace(spark, "j"), RULE, {"Orders": snapshot, "Orders_Archive": other, "Customers": other}, 2)
    assert list(target.tables) == ["Orders"]
    assert target.read("Orders").columns == ["OrderId", "Total"]
    assert rows(target.read("Orders").selectExpr("OrderId", "cast(Total as string)")) == [(1, "1.5000"), (2, None)]
    path = workspace(spark, "f")
    schema = f"{ORDERS}, op string, seq bigint"
    spark.createDataFrame([("s", "9", 2, 1, 1, "u", 5), ("s", None, 1, 1, 1, "d", 6)], schema).write.parquet(path)
    feed = job_feed(RULE, {"Orders": feeds.change_stream(spark, path, schema)})
    feeds.run_available(feeds.stream_into(feed, target, workspace(spark, "p")))
    assert rows(target.read("Orders").selectExpr("OrderId", "cast(Total as string)")) == [(2, "9.0000")]


def test_rules_must_leave_the_key(spark):
    df = spark.createDataFrame([("s", "1", 1, 0, 0)], ORDERS)
    hidden = JobRule(tables={"Orders": TableRule(["OrderId"])}, exclude_columns=["*id"])
    with pytest.raises(ValueError, match="key columns not selected"):
        prepared(df, hidden, "Orders")
    with pytest.raises(ValueError, match="without a rule"):
        load_job(spark, "unused", JobRule(tables={}), {"Orders": df})
