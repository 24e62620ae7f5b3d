"""Sources, sinks and change apply (survey groups A and D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions.conversions import ColumnSpec
from rowtide.operators import changes as ch
from rowtide.plans.jobs import with_tier_job
from rowtide.plans.replication import JobRule, TableRule, job_feed, jobs_from_plan, load_job
from rowtide.session import workspace
from rowtide.sources import sinks
from rowtide.sources import snapshot as snap
from rowtide.sources.incremental import IncrementalSnapshot
from rowtide.sources.merge_store import KeyedTable
from rowtide.sources.table_set import TableSet, TableSpec, tagged, tagged_union
from suite import standins as st
from suite.registry import query, table

KEY = ["o_orderkey"]
BUCKETS = 8
OUT = "o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as double) as o_totalprice"


def shown(df):
    """Orders rows with money as double, as both engines name it the same."""
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double"))


def final_sql(columns: str = OUT) -> str:
    return f"with {st.applied_sql()} select {columns} from final"


def keyed_orders(spark, label: str, sample) -> KeyedTable:
    return KeyedTable(spark, workspace(spark, label), KEY, sample.select(*st.ORDERS.columns).schema, BUCKETS)


def halves(feed):
    """The feed in two batches, the later seq of a key often in the earlier batch."""
    late = F.pmod(F.xxhash64("o_orderkey", "seq"), F.lit(2)) == 0
    return feed.where(~late), feed.where(late)


# ---- A: sources and sinks ------------------------------------------------------------------------


@query("select o_orderkey, o_orderstatus, o_orderdate from orders")
def scan_snapshot(spark, sf):
    return snap.snapshot(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_orderdate"])


@query(
    """with b as (select min(o_orderkey) as m from orders)
    select cast((o_orderkey - (select m from b)) // 1000 as bigint) as chunk_id, min(o_orderkey) as lo,
           max(o_orderkey) as hi, cast(count(*) as bigint) as n_rows from orders group by 1"""
)
def chunk_plan(spark, sf):
    return snap.chunk_plan(table(spark, sf, "orders"), "o_orderkey", 1000)


@query(
    """with b as (select min(o_orderkey) as m from orders)
    select o_orderkey, o_orderstatus, cast((o_orderkey - (select m from b)) // 1000 as bigint) as chunk_id from orders"""
)
def chunked_snapshot(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return snap.chunked_snapshot(rows, "o_orderkey", 1000)


_NAME_CHUNKS = """select p_name as k, count(*) as n, (row_number() over (order by p_name) - 1) // 20 as chunk_id from part group by p_name"""


@query(f"select cast(chunk_id as bigint) as chunk_id, min(k) as lo, max(k) as hi, cast(sum(n) as bigint) as n_rows from ({_NAME_CHUNKS}) group by 1")
def chunk_plan_text_key(spark, sf):
    return snap.key_chunk_plan(table(spark, sf, "part"), "p_name", 20)


@query(f"select p_partkey, p_name, cast(chunk_id as bigint) as chunk_id from part join ({_NAME_CHUNKS}) on p_name = k")
def chunked_snapshot_text_key(spark, sf):
    return snap.key_chunked_snapshot(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 20)


SNAPSHOT_SEQ = 5000


@query(
    f"""with base as ({st.base_sql()}), feed as ({st.feed_sql()})
    select {OUT}, 'r' as op, cast({SNAPSHOT_SEQ} as bigint) as seq from base
    union all select {OUT}, op, seq from feed where seq > {SNAPSHOT_SEQ}"""
)
def snapshot_then_changes(spark, sf):
    both = ch.snapshot_then_changes(st.base(spark, sf), st.feed(spark, sf), SNAPSHOT_SEQ)
    return both.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(final_sql())
def incremental_snapshot(spark, sf):
    """Chunks read while the orders change, by a run that ends after two chunks and another that goes on, then the rest of the feed."""
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    progress, target = workspace(spark, "incremental"), keyed_orders(spark, "incremental-target", base)
    last = feed.agg(F.max("seq")).first()[0]
    at = iter(range(0, 100))

    def position() -> int:
        """The source moves on by a twelfth of its changes whenever it is asked."""
        return min(last, last * next(at) // 12)

    def read(chunk):
        now = last * (4 * chunk.number + 1) // 24  # between the chunk's marks
        return ch.apply_changes(base, feed.where(F.col("seq") <= now), KEY).where(chunk.condition("o_orderkey"))

    first = IncrementalSnapshot(spark, target, progress)
    first.plan(base, size=base.count() // 4)
    first.run(read, position, lambda: feed, most=2)
    target.apply(feed.where(F.col("seq") <= last // 3), 100)
    IncrementalSnapshot(spark, target, progress).run(read, position, lambda: feed)
    target.apply(feed, 101)
    return shown(target.read())


@query(final_sql(OUT + ", case when o_orderstatus in ('U', 'V', 'S', 'N', 'R') then o_orderkey * 2 end as o_points"))
def schema_change(spark, sf):
    """A column added after the load and after the first changes: rows from before have null in it."""
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    target = keyed_orders(spark, "schema-change", base)
    target.load(base)
    wider = feed.withColumn("o_points", F.col("o_orderkey") * 2)
    target.change_schema(wider.drop("op", "seq").schema)
    target.apply(wider, 0)
    return target.read().withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(final_sql())
def upsert_sink(spark, sf):
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    target = keyed_orders(spark, "upsert-sink", base)
    target.load(base)
    target.apply(feed, 0)
    return shown(target.read())


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem")
def append_sink(spark, sf):
    full = table(spark, sf, "lineitem")
    rows = full.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    path = workspace(spark, "append-sink")
    first = F.col("l_returnflag").eqNullSafe(F.lit("N"))
    for part in (full.where(first), full.where(~first)):
        sinks.append_rows(part.select(*rows.columns), path)
    return spark.read.schema(rows.schema).parquet(path)


MULTI_SQL = f"""with {st.applied_sql(st.ORDERS, 'o_')}, {st.applied_sql(st.CUSTOMER, 'c_')}
    select 'orders' as table_name, o_orderkey as id, cast(o_custkey as bigint) as owner, o_orderstatus as status,
           cast(o_totalprice as double) as amount from o_final
    union all select 'customer', c_custkey, cast(c_nationkey as bigint), c_mktsegment, cast(c_acctbal as double) from c_final"""


def table_set(spark, sf, label: str) -> TableSet:
    specs = {
        s.table: TableSpec([s.key], st.base(spark, sf, s).schema) for s in (st.ORDERS, st.CUSTOMER)
    }
    target = TableSet(spark, workspace(spark, label), specs, buckets=4)
    target.load({s.table: st.base(spark, sf, s) for s in (st.ORDERS, st.CUSTOMER)})
    return target


def multi_feed(spark, sf):
    return tagged_union([tagged(st.feed(spark, sf, s), s.table, s.columns) for s in (st.ORDERS, st.CUSTOMER)])


def multi_rows(target: TableSet):
    parts = [
        target.read(s.table).select(
            F.lit(s.table).alias("table_name"),
            F.col(s.key).alias("id"),
            F.col(s.owner).cast("bigint").alias("owner"),
            F.col(s.status).alias("status"),
            F.col(s.price).cast("double").alias("amount"),
        )
        for s in (st.ORDERS, st.CUSTOMER)
    ]
    return parts[0].unionByName(parts[1])


@query(MULTI_SQL)
def multi_table_sync(spark, sf):
    target = table_set(spark, sf, "multi-table")
    target.apply(multi_feed(spark, sf), 0)
    return multi_rows(target)


@query(
    """select concat('{"n_nationkey":', n_nationkey, ',"n_name":"', n_name, '","n_regionkey":', n_regionkey, '}') as json
    from nation union all
    select concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","c_mktsegment":"', c_mktsegment, '"}') from customer"""
)
def json_rows_sink(spark, sf):
    path = workspace(spark, "json-rows")
    sinks.write_json_rows(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    written = spark.read.text(path).select(F.col("value").alias("json"))
    return sinks.json_rows(table(spark, sf, "nation")).unionByName(written)


@query("select o_orderkey, o_custkey, cast(o_orderkey % 8 as int) as bucket from orders")
def bucketed_target(spark, sf):
    path = workspace(spark, "bucketed")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    sinks.write_bucketed(rows, path, KEY, BUCKETS, F.pmod("o_orderkey", F.lit(BUCKETS)).cast("int"))
    return spark.read.parquet(path)


@query(
    f"""select table_schema, table_name, column_name, data_type, ordinal_position, 'test' as environment,
           'sync' as job, version from (
      select *, cast(1 as int) as version from ({st.columns_v1_sql()}) union all
      select *, cast(2 as int) as version from ({st.columns_v2_sql()}))"""
)
def versioned_catalog_write(spark, sf):
    path = workspace(spark, "catalog")
    names = ["table_schema", "table_name", "column_name", "data_type", "ordinal_position"]
    versions = {1: st.columns_v1(spark, sf).select(*names), 2: st.columns_v2(spark, sf).select(*names)}
    for number, catalog in versions.items():
        sinks.write_catalog_version(catalog, path, "test", "sync", number)
    schema = versions[1].schema
    return sinks.read_catalog_versions(spark, path, schema)


# ---- D: change apply -----------------------------------------------------------------------------


@query(f"with feed as ({st.feed_sql()}), latest as ({st.latest_sql('feed', 'o_orderkey')}) select {OUT}, op, seq from latest")
def latest_change_per_key(spark, sf):
    latest = ch.latest_change_per_key(st.feed(spark, sf), KEY)
    return latest.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(f"with feed as ({st.feed_sql()}), latest as ({st.latest_sql('feed', 'o_orderkey')}) select {OUT}, op, seq from latest")
def latest_change_by_hash(spark, sf):
    latest = ch.latest_change_by_hash(st.feed(spark, sf), KEY)
    return latest.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(final_sql())
def apply_changes(spark, sf):
    return shown(ch.apply_changes(st.base(spark, sf), st.feed(spark, sf), KEY))


@query(
    f"""with {st.applied_sql()} select {OUT} from base union all
    select {OUT} from latest where op <> 'd' and o_orderkey not in (select o_orderkey from base)"""
)
def apply_inserts(spark, sf):
    return shown(ch.apply_inserts(st.base(spark, sf), st.feed(spark, sf), KEY))


@query(
    f"""with {st.applied_sql()}, hit as (select * from latest where op <> 'd')
    select b.o_orderkey, coalesce(l.o_custkey, b.o_custkey) as o_custkey,
           coalesce(l.o_orderstatus, b.o_orderstatus) as o_orderstatus,
           cast(coalesce(l.o_totalprice, b.o_totalprice) as double) as o_totalprice
    from base b left join hit l on l.o_orderkey = b.o_orderkey"""
)
def apply_updates(spark, sf):
    return shown(ch.apply_updates(st.base(spark, sf), st.feed(spark, sf), KEY))


DELETED_SQL = f"""with {st.applied_sql()} select {OUT} from base
    where o_orderkey not in (select o_orderkey from latest where op = 'd')"""


@query(DELETED_SQL)
def apply_deletes(spark, sf):
    return shown(ch.apply_deletes(st.base(spark, sf), st.feed(spark, sf), KEY))


@query(DELETED_SQL)
def changes_delete_anti(spark, sf):
    gone = ch.latest_change_per_key(st.feed(spark, sf), KEY).where("op = 'd'")
    return shown(ch.without_keys(st.base(spark, sf), gone, KEY))


@query(final_sql())
def idempotent_reapply(spark, sf):
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    state = ch.merge_state(ch.as_state(base), feed, KEY)
    return shown(ch.live_rows(ch.merge_state(state, feed, KEY)))


@query(final_sql())
def out_of_order_changes(spark, sf):
    state = ch.as_state(st.base(spark, sf))
    for batch in halves(st.feed(spark, sf)):
        state = ch.merge_state(state, batch, KEY)
    return shown(ch.live_rows(state))


@query(final_sql())
def resync_from_scratch(spark, sf):
    """The same table twice: changes and a compaction, then a new snapshot and a new stream whose batches start at 0 again."""
    base, feed = st.base(spark, sf), st.feed(spark, sf)
    target = keyed_orders(spark, "resync", base)
    target.load(base)
    target.apply(feed.where("seq % 2 = 0"), 0)
    target.apply(feed.limit(0), 1)
    target.compact()
    target.load(base)
    for k, batch in enumerate(halves(feed)):
        target.apply(batch, k)
        target.compact()
    return shown(target.read())


@query(final_sql())
def compact(spark, sf):
    base = st.base(spark, sf)
    target = keyed_orders(spark, "compact", base)
    target.load(base)
    for k, batch in enumerate(halves(st.feed(spark, sf))):
        target.apply(batch, k)
        target.compact()
    return shown(target.read())


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_quantity * 2 as double_quantity,
    l_extendedprice * (1 - l_discount) as net_price, upper(l_returnflag) || '-' || l_linestatus as state from lineitem"""
)
def recompute_derived(spark, sf):
    rows = table(spark, sf, "lineitem")
    derived = ch.with_computed(
        rows,
        {
            "double_quantity": "l_quantity * 2",
            "net_price": "l_extendedprice * (1 - l_discount)",
            "state": "concat(upper(l_returnflag), '-', l_linestatus)",
        },
    )
    return derived.select("l_orderkey", "l_linenumber", "l_partkey", "double_quantity", "net_price", "state")


def _versions(spark, sf):
    base = st.base(spark, sf)
    return base, ch.apply_changes(base, st.feed(spark, sf), KEY)


@query(
    f"""with {st.applied_sql()},
    s as (select 'orders' as table_name, count(*) as n from base union all select 'customer', count(*) from customer),
    t as (select 'orders' as table_name, count(*) as n from final union all select 'customer', count(*) from customer)
    select s.table_name, cast(s.n as bigint) as source_rows, cast(t.n as bigint) as target_rows,
           cast(t.n - s.n as bigint) as difference, t.n = s.n as matches from s join t on s.table_name = t.table_name"""
)
def reconcile_counts(spark, sf):
    base, final = _versions(spark, sf)
    customer = table(spark, sf, "customer")
    return ch.reconcile_counts({"orders": base, "customer": customer}, {"orders": final, "customer": customer})


RECONCILED_SQL = f"""with {st.applied_sql()}
    select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey,
           case when f.o_orderkey is null then 'missing' when b.o_orderkey is null then 'extra' else 'different' end as status
    from base b full outer join final f on b.o_orderkey = f.o_orderkey
    where b.o_custkey is distinct from f.o_custkey or b.o_orderstatus is distinct from f.o_orderstatus
       or b.o_totalprice is distinct from f.o_totalprice"""


@query(RECONCILED_SQL)
def reconcile_rows(spark, sf):
    return ch.reconcile_rows(*_versions(spark, sf), KEY)


@query(RECONCILED_SQL)
def reconcile_tree(spark, sf):
    """The same by digests of key ranges."""
    return ch.reconcile_tree(*_versions(spark, sf), KEY)


_JOB = JobRule(
    tables={
        "orders": TableRule(["o_orderkey"], exclude_columns=["o_custkey"], specs=[ColumnSpec("o_orderstatus", "char", length=2)]),
        "customer": TableRule(
            ["c_custkey"],
            include_columns=["c_custkey", "c_acctbal"],
            specs=[ColumnSpec("c_acctbal", "decimal", precision=9, scale=2)],
        ),
    },
    exclude_tables=["*_archive", "supp*"],
    exclude_columns=["*nation*"],
)


@query(
    f"""with {st.applied_sql(st.ORDERS, 'o_')}, {st.applied_sql(st.CUSTOMER, 'c_')}
    select 'orders' as table_name, o_orderkey as id, rpad(o_orderstatus, 2, ' ') as status, cast(o_totalprice as double) as amount from o_final
    union all select 'customer', c_custkey, null, cast(cast(c_acctbal as decimal(9,2)) as double) from c_final"""
)
def replicate_job(spark, sf):
    """Two of three tables, with columns left out and converted, from snapshot through a feed to rows."""
    sources = {s.table: s for s in (st.ORDERS, st.CUSTOMER)}
    snapshots = {n: st.base(spark, sf, s) for n, s in sources.items()} | {"supplier": table(spark, sf, "supplier")}
    target = load_job(spark, workspace(spark, "job"), _JOB, snapshots, buckets=4)
    target.apply(job_feed(_JOB, {n: st.feed(spark, sf, s) for n, s in sources.items()}), 0)
    orders = target.read("orders").select(
        F.lit("orders").alias("table_name"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("double").alias("amount"),
    )
    customer = target.read("customer").select(
        F.lit("customer").alias("table_name"),
        F.col("c_custkey").alias("id"),
        F.lit(None).cast("string").alias("status"),
        F.col("c_acctbal").cast("double").alias("amount"),
    )
    return orders.unionByName(customer)


_COUNTED = " union all ".join(f"select '{t}' as name, cast(count(*) as bigint) as n from {t}" for t in ("orders", "customer", "supplier"))


@query(
    f"""with u as ({_COUNTED}), j as (select name, n, case when n > 1000 then concat('dbo_', name) else 'dbo_low_io_bundle' end as job from u)
    select job, name as table_name, n as n_rows from j"""
)
def plan_to_jobs(spark, sf):
    """Tables planned by their size, a job rule per planned job, one run per job, and the rows each made."""
    names = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"}
    sources = {n: table(spark, sf, n).select(k) for n, k in names.items()}
    counts = None
    for n, df in sources.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), F.lit("dbo").alias("schema"), F.when(F.col("n") > 1000, "high").otherwise("low").alias("category"))
        counts = one if counts is None else counts.unionByName(one)
    base = JobRule(tables={n: TableRule([k]) for n, k in names.items()})
    out = None
    for job, rule in jobs_from_plan(with_tier_job(counts, "schema", "name"), "name", base).items():
        target = load_job(spark, workspace(spark, "planned"), rule, sources, buckets=2)
        for n in rule.tables:
            part = target.read(n).agg(F.count("*").alias("n_rows")).select(F.lit(job).alias("job"), F.lit(n).alias("table_name"), "n_rows")
            out = part if out is None else out.unionByName(part)
    return out
