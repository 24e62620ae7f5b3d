"""Activity joins, aggregates, rankings and reports (survey groups C, E, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions.measures import latest_of, read_write_ratio, tier
from rowtide.operators import activity as act
from rowtide.operators import quality
from rowtide.operators.ranking import Desc, ranked
from rowtide.plans import jobs
from rowtide.session import workspace
from rowtide.sources import sinks
from suite import standins as st
from suite.registry import query, table


def entities(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"))


def parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("entity"))


def orders_as_partitions(spark, sf):
    """Orders as partitions of their customer; the status gives the index they belong to."""
    index = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity"), index.alias("index_id"), (F.col("o_orderkey") % 7).alias("rows")
    )


ORDER_ROWS_SQL = """select o_custkey as entity, cast(sum(o_orderkey % 7) as bigint) as row_count from orders
  where o_orderstatus in ('F', 'O') group by o_custkey"""


def order_counts(spark, sf):
    counted = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"))
    return counted.agg(F.count("*").alias("row_count"))


def covered(spark, sf):
    """Every customer with its activity, the frame most reports start from."""
    rolled = act.activity_rollup(st.index_usage(spark, sf), "entity")
    return act.full_coverage(entities(spark, sf), rolled, "entity", order_counts(spark, sf), st.HIGH, st.LOW)


# ---- C: joins --------------------------------------------------------------------------------------


@query(st.COVERAGE_SQL)
def activity_full_coverage(spark, sf):
    return covered(spark, sf)


@query(
    f"""select c_custkey as entity, coalesce(total_io, 0) as total_io, coalesce(row_count, 0) as row_count from customer
    left join ({st.ROLLUP_SQL}) u on u.entity = c_custkey left join ({ORDER_ROWS_SQL}) r on r.entity = c_custkey"""
)
def join_row_counts(spark, sf):
    rolled = act.activity_rollup(st.index_usage(spark, sf), "entity")
    counts = act.row_counts(orders_as_partitions(spark, sf), "entity")
    return act.full_coverage(entities(spark, sf), rolled, "entity", counts).select("entity", "total_io", "row_count")


THREE_WAY_SQL = f"""select o.entity, total_reads, total_updates, locks, total_reads + total_updates + locks // 10 as total_io,
    row_count, used_kb, reserved_kb from ({st.OPERATIONAL_SQL}) o join ({st.STORAGE_SQL}) s on o.entity = s.entity
    join part on o.entity = p_partkey"""


@query(THREE_WAY_SQL)
def join_three_way_stats(spark, sf):
    return act.three_way_stats(st.operational(spark, sf), st.partition_stats(spark, sf), parts(spark, sf), "entity")


@query(f"select c_custkey as entity, row_count from customer left join ({ORDER_ROWS_SQL}) r on r.entity = c_custkey")
def left_join_on_filter(spark, sf):
    return act.row_counts_of_all(entities(spark, sf), orders_as_partitions(spark, sf), "entity")


# ---- E: aggregates ---------------------------------------------------------------------------------


@query(st.ROLLUP_SQL)
def activity_rollup(spark, sf):
    return act.activity_rollup(st.index_usage(spark, sf), "entity")


@query(f"select o.*, row_count, used_kb, reserved_kb from ({st.OPERATIONAL_SQL}) o join ({st.STORAGE_SQL}) s on o.entity = s.entity")
def operational_rollup(spark, sf):
    rolled = act.operational_rollup(st.operational(spark, sf), "entity")
    return rolled.join(act.storage_rollup(st.partition_stats(spark, sf), "entity"), "entity")


@query(f"select *, total_reads + total_updates + locks // 10 as total_io from ({st.OPERATIONAL_SQL})")
def lock_weighted_io(spark, sf):
    return act.with_lock_weight(act.operational_rollup(st.operational(spark, sf), "entity"))


@query(ORDER_ROWS_SQL)
def row_count_rollup(spark, sf):
    return act.row_counts(orders_as_partitions(spark, sf), "entity")


@query(
    f"""select entity, row_count, row_count * 10 as total_io, row_count * 10 as total_reads, cast(0 as bigint) as total_updates,
    cast(0 as double) as read_write_ratio, {st.tier_sql('row_count * 10', 300, 150)} as category
    from (select c_custkey as entity, coalesce(row_count, 0) as row_count from customer left join ({ORDER_ROWS_SQL}) r on r.entity = c_custkey)"""
)
def estimate_from_rows(spark, sf):
    counts = act.row_counts_of_all(entities(spark, sf), orders_as_partitions(spark, sf), "entity")
    return act.estimate_from_rows(counts, 300, 150)


_FALLBACK_SQL = f"""
  select c_custkey as entity, coalesce(r.row_count, 0) as row_count,
    case when u.entity is not null then 'usage' when o.entity is not null then 'operational'
         when r.entity is not null then 'rows' else 'none' end as stat_source,
    coalesce(u.total_reads, o.total_reads, r.row_count * 10, 0) as total_reads,
    coalesce(u.total_updates, o.total_updates, 0) as total_updates,
    coalesce(u.total_io, o.total_reads + o.total_updates + o.locks // 10, r.row_count * 10, 0) as total_io
  from customer left join ({st.ROLLUP_SQL}) u on u.entity = c_custkey
  left join (select * from ({st.OPERATIONAL_SQL}) where locks >= 350) o on o.entity = c_custkey
  left join ({ORDER_ROWS_SQL}) r on r.entity = c_custkey"""


@query(
    f"""select *, case when stat_source = 'rows' then 0.0::double else {st.RATIO_SQL} end as read_write_ratio,
    {st.tier_sql("case when stat_source = 'rows' then total_io else total_updates end", 60, 40)} as category from ({_FALLBACK_SQL})"""
)
def fallback_chain(spark, sf):
    """Events cover the first customers, part counters with many locks stand in for some, orders for others."""
    usage = act.activity_rollup(st.index_usage(spark, sf), "entity")
    operational = act.with_lock_weight(act.operational_rollup(st.operational(spark, sf), "entity"))
    known = operational.where("locks >= 350")
    counts = act.row_counts(orders_as_partitions(spark, sf), "entity")
    return act.fallback_chain(entities(spark, sf), usage, known, counts, "entity", 60, 40)


@query(
    f"""select entity, total_reads, total_updates, {st.RATIO_SQL} as read_write_ratio from (
      select user_id as entity, cast(sum(case when event_type in ('view', 'click') then 1 else 0 end) as bigint) as total_reads,
             cast(sum(case when event_type = 'purchase' and event_id % 5 = 0 then 1 else 0 end) as bigint) as total_updates
      from events group by user_id)""",
    name="read_write_ratio",
)
def read_write_ratio_by_entity(spark, sf):
    events = table(spark, sf, "events")
    rolled = events.groupBy(F.col("user_id").alias("entity")).agg(
        F.count_if(F.col("event_type").isin("view", "click")).alias("total_reads"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("event_id") % 5 == 0)).alias("total_updates"),
    )
    return rolled.withColumn("read_write_ratio", read_write_ratio(F.col("total_reads"), F.col("total_updates")))


@query(f"select entity, total_updates, {st.tier_sql('total_updates')} as category from ({st.ROLLUP_SQL})", name="tier")
def tier_by_writes(spark, sf):
    rolled = act.activity_rollup(st.index_usage(spark, sf), "entity")
    return rolled.select("entity", "total_updates", tier(F.col("total_updates"), st.HIGH, st.LOW).alias("category"))


_TIER_COUNTS = " union all ".join(
    f"select '{t}' as tier, cast(count(*) filter (category = '{t}') as bigint) as n_entities from c" for t in ("high", "medium", "low")
)


@query(f"with c as ({st.COVERAGE_SQL}) select 'total' as tier, cast(count(*) as bigint) as n_entities from c union all {_TIER_COUNTS}")
def tier_summary(spark, sf):
    return act.tier_summary(covered(spark, sf))


@query("select (select count(*) from orders) + 0 as n_rows")
def global_totals(spark, sf):
    return act.global_totals(table(spark, sf, "orders"))


_SUMMED_SQL = """cast(count(*) as bigint) as n_tables, cast(sum(total_io) as bigint) as estimated_io_ops,
  cast(sum(total_updates) as bigint) as estimated_update_ops, cast(sum(row_count) as bigint) as total_rows"""


@query(f"select category, {_SUMMED_SQL} from ({st.COVERAGE_SQL}) group by category")
def bundle_totals(spark, sf):
    return act.totals_by(covered(spark, sf), ["category"])


REPORT_SQL = f"""with c as ({st.COVERAGE_SQL})
  select 'table' as section, cast(entity as varchar) as name, cast(null as bigint) as value, total_io, category, row_count from c
  union all select 'summary', tier, n_entities, null, null, null from (
    select 'total' as tier, cast(count(*) as bigint) as n_entities from c union all {_TIER_COUNTS})
  union all select 'threshold', 'high', {st.HIGH}, null, null, null
  union all select 'threshold', 'low', {st.LOW}, null, null, null"""


def _flat(report):
    return report.select("section", "name", "value", "entry.total_io", "entry.category", "entry.row_count")


@query(REPORT_SQL)
def activity_report(spark, sf):
    return _flat(act.activity_report(covered(spark, sf), "entity", st.HIGH, st.LOW))


_JOB_NAME = "case when category = 'high' then concat('dbo_', entity) else concat('dbo_', category, '_io_bundle') end"


@query(f"{REPORT_SQL} union all select 'config', {_JOB_NAME}, cast(count(*) as bigint), null, null, null from c group by 2")
def report_sink(spark, sf):
    """The report with the jobs of its plan merged in, written and read again."""
    rows = covered(spark, sf)
    plan = jobs.with_tier_job(rows.withColumn("schema", F.lit("dbo")), "schema", "entity")
    report = act.activity_report(rows, "entity", st.HIGH, st.LOW, jobs=plan)
    path = workspace(spark, "report")
    sinks.write_report(report, path)
    return _flat(spark.read.schema(report.schema).option("basePath", path).json(path))


def _field(c: str) -> str:
    return f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"


_ORDER_TEXT = " || ".join(_field(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "cast(o_totalprice as decimal(19,4))", "o_orderdate"))


_SUMMED_DIGEST = " || '-' || ".join(f"cast(sum(('0x' || substr(h, {at}, 16))::ubigint::decimal(38,0)) as varchar)" for at in (1, 17, 33, 49))


@query(
    f"""select o_orderpriority, cast(count(*) as bigint) as n_rows, concat_ws('-', cast(count(*) as varchar), {_SUMMED_DIGEST}) as fingerprint
    from (select o_orderpriority, sha256({_ORDER_TEXT}) as h from orders) group by o_orderpriority"""
)
def table_fingerprint(spark, sf):
    rows = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast(st.MONEY))
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate"]
    return quality.table_fingerprint(rows, names, by=["o_orderpriority"])


# ---- G: order --------------------------------------------------------------------------------------


@query(f"select entity, total_io, row_number() over (order by total_io desc, entity) as activity_rank from ({st.COVERAGE_SQL})")
def rank_by_activity(spark, sf):
    rows = covered(spark, sf).select("entity", "total_io")
    return ranked(rows, [], [Desc("total_io"), "entity"], rank="activity_rank")


@query(f"select c_custkey as entity, row_count from customer left join ({ORDER_ROWS_SQL}) r on r.entity = c_custkey order by row_count desc nulls last")
def order_by_row_count(spark, sf):
    counts = act.row_counts_of_all(entities(spark, sf), orders_as_partitions(spark, sf), "entity")
    return counts.orderBy(F.desc_nulls_last("row_count"))


@query(f"select entity, greatest(last_seek, last_scan, last_update) as last_activity from ({st.ROLLUP_SQL})")
def last_activity(spark, sf):
    rolled = act.activity_rollup(st.index_usage(spark, sf), "entity")
    return rolled.select("entity", latest_of(F.col("last_seek"), F.col("last_scan"), F.col("last_update")).alias("last_activity"))


@query(f"select entity, total_updates, category from ({st.COVERAGE_SQL}) order by total_updates desc, entity limit 20")
def top_k_hot(spark, sf):
    rows = covered(spark, sf).select("entity", "total_updates", "category")
    return act.top_hot(rows, 20, "entity")
