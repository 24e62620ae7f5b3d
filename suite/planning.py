"""Groups, bundles and job plans (survey groups C, E, F, H and K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.operators import lookup
from rowtide.operators.ranking import chunk_groups as chunked
from rowtide.plans import jobs
from suite import standins as st
from suite.activity import _SUMMED_SQL
from suite.registry import query, table

TIER_JOB_SQL = f"""
  select *, case when category = 'high' then concat(schema_name, '_', name)
                 else concat(schema_name, '_', category, '_io_bundle') end as job_name,
         case when category = 'high' then 'high' else 'bundle' end as job_category from ({st.NAMED_SQL})"""


@query("""select o_orderkey, o_orderpriority, (row_number() over (partition by o_orderpriority order by o_orderkey) - 1) // 500 + 1 as group_no from orders""")
def chunk_groups(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return chunked(rows, ["o_orderpriority"], ["o_orderkey"], 500)


@query(f"select job_name, concat(job_name, '_config.yaml') as job_file, job_category, {_SUMMED_SQL} from ({TIER_JOB_SQL}) group by all")
def plan_by_tier(spark, sf):
    return jobs.plan_by_tier(st.named_activity(spark, sf), "schema_name", "name")


@query(f"select name, job_name, job_category from ({TIER_JOB_SQL})")
def union_tiers(spark, sf):
    return jobs.union_tiers(st.named_activity(spark, sf), "schema_name", "name").select("name", "job_name", "job_category")


@query(
    """select 'orders_sync' as job, o_orderkey as id, cast(o_custkey as bigint) as owner from orders
    union all select 'customer_sync', c_custkey, cast(c_nationkey as bigint) from customer
    union all select 'supplier_sync', s_suppkey, cast(s_nationkey as bigint) from supplier"""
)
def union_job_outputs(spark, sf):
    def output(name: str, key: str, owner: str):
        return table(spark, sf, name).select(F.col(key).alias("id"), F.col(owner).cast("bigint").alias("owner"))

    return jobs.union_job_outputs(
        {
            "orders_sync": output("orders", "o_orderkey", "o_custkey"),
            "customer_sync": output("customer", "c_custkey", "c_nationkey"),
            "supplier_sync": output("supplier", "s_suppkey", "s_nationkey"),
        }
    )


@query(f"select name, {st.DOMAIN_SQL} as domain from ({st.NAMED_SQL})")
def extract_domain(spark, sf):
    named = st.named_activity(spark, sf).select("name")
    return named.select("name", jobs.extract_domain(F.col("name")).alias("domain"))


@query(f"select name, domain, total_updates, group_name from ({st.GROUPED_SQL})")
def group_by_domain(spark, sf):
    grouped = jobs.group_by_domain(st.named_activity(spark, sf), "name")
    return grouped.select("name", "domain", "total_updates", "group_name")


@query(f"select group_name, string_agg(name, ',' order by name) as members, cast(count(*) as int) as n_members from ({st.GROUPED_SQL}) group by group_name")
def bundle_members(spark, sf):
    grouped = jobs.group_by_domain(st.named_activity(spark, sf), "name")
    listed = jobs.group_members(grouped, "name")
    return listed.select("group_name", F.array_join("members", ",").alias("members"), F.size("members").alias("n_members"))


@query(f"select name, group_name, n_members from ({st.GROUPED_SQL}) join (select group_name, cast(count(*) as int) as n_members from ({st.GROUPED_SQL}) group by 1) using (group_name)")
def array_membership_join(spark, sf):
    grouped = jobs.group_by_domain(st.named_activity(spark, sf), "name")
    listed = jobs.group_members(grouped, "name").withColumn("n_members", F.size("members"))
    return lookup.array_membership(grouped.select("name"), listed, "name", "members")


@query(f"select p.name, t.job_name from ({st.NAMED_SQL}) p left join ({TIER_JOB_SQL}) t on t.name = p.name")
def table_to_job(spark, sf):
    named = st.named_activity(spark, sf)
    plan = jobs.with_tier_job(named, "schema_name", "name")
    return jobs.table_to_job(named.select("name"), plan, "name")


@query(
    f"""select name, total_io, activity_rank, case when (activity_rank - 1) % 14 < 7 then (activity_rank - 1) % 14 + 1
      else 14 - (activity_rank - 1) % 14 end as job_no
    from (select name, total_io, row_number() over (order by total_io desc, name) as activity_rank from ({st.NAMED_SQL}))"""
)
def balanced_plan(spark, sf):
    named = st.named_activity(spark, sf).select("name", "total_io")
    return jobs.balanced_plan(named, "name", 7)


@query(
    f"""with recursive r as (select name, total_io, row_number() over (order by total_io desc, name) as rn from ({st.NAMED_SQL})),
    step(k, loads, job) as (select 0, [0, 0, 0, 0, 0, 0, 0]::bigint[], 0
      union all select k + 1, list_transform(range(1, 8), lambda i: loads[i] + case when i = p then total_io else 0 end)::bigint[], p
      from (select s.k, s.loads, r.total_io, list_position(s.loads, list_min(s.loads)) as p from step s join r on r.rn = s.k + 1 where s.k < 20)),
    l as (select unnest(range(1, 8)) as j, unnest(loads) as load from (select loads from step order by k desc limit 1)),
    o as (select j, load, row_number() over (order by load, j) as k, sum(load) over (order by load, j) as filled, lead(load) over (order by load, j) as higher from l),
    v as (select k, ((select coalesce(sum(total_io), 0) from r where rn > 20) + filled + k - 1) // k as level, higher from o),
    w as (select k, level from v where higher is null or level <= higher order by k limit 1),
    e as (select j, sum(case when o.k <= w.k then greatest(0, w.level - load) else 0 end) over (order by j) as up_to from o, w),
    t as (select name, total_io, coalesce(sum(total_io) over (order by name rows between unbounded preceding and 1 preceding), 0) as at from r where rn > 20)
    select name, total_io, cast(job as bigint) as job_no from r join step on step.k = rn where rn <= 20
    union all select name, total_io, cast(coalesce((select min(j) from e where j < 7 and t.at < e.up_to), 7) as bigint) from t"""
)
def balanced_by_amount(spark, sf):
    """The heaviest 20 one by one to the lightest job, the others by running sums."""
    named = st.named_activity(spark, sf).select("name", "total_io")
    return jobs.balanced_by_amount(named, "name", 7, head=20)
