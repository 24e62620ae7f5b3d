"""What a task or a batch holds does not grow with the input: tasks by the size of the files read, batches by the feed."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from rowtide import session
from rowtide.operators import catalog as cat
from rowtide.sources.merge_store import KeyedTable
from suite import catalogs, streams


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "TASK_BYTES", 512)


@pytest.fixture
def columns(spark, tmp_path):
    path = str(tmp_path / "columns")
    spark.range(2000).selectExpr(
        "'s' as table_schema", "concat('T', id % 400) as table_name", "concat('c', id) as column_name", "'int' as data_type", "cast(id as int) as ordinal_position"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_checksums_are_summed_in_tasks_by_input(spark, columns, small_tasks, capsys):
    tasks = session.input_tasks(columns)
    assert tasks > spark.sparkContext.defaultParallelism
    keys = columns.where("ordinal_position % 3 = 0")
    placed = cat.key_by_position(keys, columns)
    assert placed.rdd.getNumPartitions() == tasks
    sums = cat.schema_checksum(columns, placed)
    sums.explain()
    dealt = re.findall(r"hashpartitioning\(table_schema#\d+, table_name#\d+, column_name#\d+, (\d+)\), REPARTITION_BY_NUM", capsys.readouterr().out)
    assert set(dealt) == {str(tasks)} and len(dealt) == 3
    here = spark.createDataFrame(columns.collect(), columns.schema)  # read from no file
    again = cat.schema_checksum(here, cat.key_by_position(here.where("ordinal_position % 3 = 0"), here))
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, again.collect()))


def test_a_large_base_is_written_by_many_tasks(spark, tmp_path, small_tasks):
    path = str(tmp_path / "rows")
    spark.range(4000).select("id", F.col("id").cast("string").alias("v")).coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    target = KeyedTable(spark, str(tmp_path / "kept"), ["id"], rows.schema, 2)
    target.load(rows)
    assert len(glob.glob(f"{tmp_path}/kept/base/version=0/bucket=*/*.parquet")) > 2
    assert sorted(map(tuple, target.read().collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("name", ["keyed_state_latest_jvm", "micro_batch_policy"])
def test_batches_do_not_follow_the_shuffle_width(spark, tmp_path, monkeypatch, name):
    spark.range(20000).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus", "cast(id as double) as o_totalprice"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    applied, apply = [], KeyedTable.apply
    monkeypatch.setattr(KeyedTable, "apply", lambda self, rows, batch_id, ignore=(): (applied.append(batch_id), apply(self, rows, batch_id, ignore))[1])
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = getattr(streams, name)(spark, str(tmp_path)).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert 1 < len(set(applied)) <= 16
    assert rows == streams.shown(streams.ch.apply_changes(streams.st.base(spark, str(tmp_path)), streams.st.feed(spark, str(tmp_path)), streams.KEY)).count()


def test_changed_tables_deals_out_lines_alone(spark, tmp_path):
    spark.range(6000).selectExpr(
        "id div 4 as l_orderkey", "id * 7 as l_partkey", "id * 3 as l_suppkey", "cast(id % 4 + 1 as int) as l_linenumber", "cast(id as double) as l_quantity"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = catalogs.changed_tables(spark, str(tmp_path))
    assert len(found.collect()) > 500
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan
    written = re.findall(r"^[\s:+-]*Exchange hashpartitioning.*", plan, re.M)
    assert len(written) == 3 and all("l_orderkey" in line and "REPARTITION_BY_NUM" in line for line in written)
