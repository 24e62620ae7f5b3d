"""Physical plans: what is pushed down, combined early, and not shuffled."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rowtide.operators import activity, changes, selection, versions
from rowtide.session import workspace
from rowtide.sources.merge_store import KeyedTable
from suite import standins as st

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(selection.where_equal(orders, {"o_orderstatus": "F"}).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_latest_change_combines_before_its_only_shuffle(spark):
    text = plan(changes.latest_change_per_key(st.feed(spark, SF), ["o_orderkey"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("partial_max") > text.index("Exchange hashpartitioning")  # printed top down


def test_small_feed_does_not_shuffle_the_base(spark):
    text = plan(changes.apply_changes(st.base(spark, SF), st.feed(spark, SF), ["o_orderkey"]))
    assert "LeftAnti, BuildRight" in text and "SortMergeJoin" not in text


def test_large_feed_joins_by_shuffle(spark, no_broadcast):
    text = plan(changes.apply_changes(st.base(spark, SF), st.feed(spark, SF), ["o_orderkey"]))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text and "Cartesian" not in text


def test_retention_limits_groups_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(versions.retain_versions(events, "user_id", "event_id", "ts", 3, "2024-01-10", "2024-01-01"))
    assert text.count("WindowGroupLimit") == 2
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_top_k_does_not_sort_everything(spark):
    rolled = activity.activity_rollup(st.index_usage(spark, SF), "entity")
    text = plan(activity.top_hot(rolled, 5, "entity"))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_keyed_table_reads_and_compacts_without_moving_the_base_twice(spark):
    base, feed = st.base(spark, SF), st.feed(spark, SF)
    table = KeyedTable(spark, workspace(spark, "plan"), ["o_orderkey"], base.schema, buckets=4)
    table.load(base)
    assert "Exchange" not in plan(table.read())
    table.apply(feed, 0)
    merged = plan(table.read())
    assert "SortMergeJoin" not in merged and "Exchange hashpartitioning" not in merged
    store = table.store
    rows = store._base(store._manifest().parts, None).unionByName(store._deltas(store.open_deltas(), None))
    assert plan(store._merged(rows, 4)).count("Exchange ") == 1
    table.compact()
    assert "Exchange" not in plan(table.read().where(F.col("o_orderkey") > 5))
