"""Projections, filters and predicates (survey group B) and ordering (group G, names)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions.measures import tier
from rowtide.functions.text import glob_match, regex_match, selected
from rowtide.operators import selection as sel
from suite import standins as st
from suite.registry import query, table

GLOBS = ["*RING", "red *", "blue b?lt", "small widget"]


@query(
    """select p_partkey, p_name, (lower(p_name) like '%ring' or lower(p_name) like 'red %'
    or lower(p_name) like 'blue b_lt' or lower(p_name) = 'small widget') as matches, true as matches_empty from part""",
    name="glob_match",
)
def glob_match_names(spark, sf):
    part = table(spark, sf, "part")
    name = F.col("p_name")
    return part.select("p_partkey", "p_name", glob_match(name, GLOBS).alias("matches"), glob_match(name, []).alias("matches_empty"))


@query(
    """select p_partkey, p_name from part where (lower(p_name) like '%ring' or lower(p_name) like '%bolt')
    and not lower(p_name) like 'red%'"""
)
def include_exclude(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return sel.select_names(part, "p_name", include=["*ring", "*BOLT"], exclude=["Red*"])


@query("select p_partkey, p_name, regexp_matches(p_name, '(?i)^red.*|.*_bolt$|W[aeiou]d') as matches from part", name="regex_match")
def regex_match_names(spark, sf):
    test = regex_match(F.col("p_name"), ["^red.*", ".*_bolt$", "W[aeiou]d"])
    return table(spark, sf, "part").select("p_partkey", "p_name", test.alias("matches"))


@query("select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def project_columns(spark, sf):
    return sel.project_columns(table(spark, sf, "orders"), include=["O_ORDER*", "*price"], exclude=["*date"])


@query("select l_orderkey, l_quantity, l_shipdate from lineitem")
def project_override(spark, sf):
    return sel.project_override(
        table(spark, sf, "lineitem"),
        exclude_columns=["l_tax", "l_discount"],
        include_columns=["l_orderkey", "l_quantity", "l_shipdate", "l_tax", "L_PARTKEY"],
    )


@query("select l_orderkey, l_linenumber, l_quantity from lineitem")
def drop_computed(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    wide = rows.withColumns({"half": F.col("l_quantity") / 2, "twice": F.col("l_quantity") * 2})
    return sel.drop_derived(sel.mark_derived(wide, ["half"]), ["twice"])


@query("select o_custkey, o_orderkey, o_orderdate from orders")
def explicit_select(spark, sf):
    return sel.explicit_select(table(spark, sf, "orders"), ["o_custkey", "o_orderkey", "o_orderdate"])


@query("select l_linenumber, l_orderkey, l_partkey, l_suppkey, l_returnflag from lineitem")
def key_first_order(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return sel.key_first(rows, ["l_linenumber", "l_orderkey"])


_SYSTEM_NAME = """case when o_orderkey % 11 = 0 then concat('sys', o_orderkey) when o_orderkey % 11 = 1 then concat('MS', o_orderkey)
  when o_orderkey % 11 = 2 then concat('trace_', o_orderkey) when o_orderkey % 11 = 3 then concat('traceX', o_orderkey)
  when o_orderkey % 11 = 4 then concat('dt', o_orderkey) when o_orderkey % 11 = 5 then concat('ms', o_orderkey)
  else concat('Orders', o_orderkey) end"""


@query(
    f"""select name from (select {_SYSTEM_NAME} as name from orders) where name not like 'sys%' and name not like 'MS%'
    and name not like 'dt%' and name not like 'trace_%'"""
)
def system_name_filter(spark, sf):
    names = table(spark, sf, "orders").select(F.expr(_SYSTEM_NAME).alias("name"))
    return sel.without_system_names(names, "name")


@query("select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderstatus = 'F' and o_orderpriority = '2-HIGH'")
def param_equality(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return sel.where_equal(rows, {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"})


@query(
    """select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus in ('F', 'P')
    and o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')"""
)
def in_list(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    wanted = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    return sel.in_list(sel.in_list(rows, "o_orderstatus", ["F", "P"]), "o_custkey", wanted)


@query(
    """select p_partkey, p_name, p_brand from part where lower(p_name) not in ('red widget', 'blue bolt')
    and lower(p_brand) not in (select lower(replace(s_name, 'Supplier#00000000', 'BRAND#')) from supplier)"""
)
def exclude_list(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    names = table(spark, sf, "supplier").select(F.replace("s_name", F.lit("Supplier#00000000"), F.lit("BRAND#")).alias("n"))
    return sel.exclude_list(sel.exclude_list(rows, "p_name", ["Red Widget", "BLUE BOLT"]), "p_brand", names)


@query(f"select * from (select c_custkey, c_name, {st.tier_sql('c_acctbal', 8000, 3000)} as category from customer) where category = 'medium'")
def tier_filter(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", tier(F.col("c_acctbal"), 8000, 3000).alias("category"))
    return sel.in_tier(rows, "medium")


@query("select c_custkey, c_nationkey, c_mktsegment from customer")
def sensitive_projection(spark, sf):
    return sel.sensitive_projection(
        table(spark, sf, "customer"), denied=["*name", "*ACCTBAL*"], allowed=["c_custkey", "c_nationkey", "c_mktsegment"]
    )


@query(
    """select c_custkey, coalesce(n, 0) as n_orders, coalesce(t, 0.0) as open_total from customer left join
    (select o_custkey, cast(count(*) as bigint) as n, cast(sum(cast(case when o_orderstatus = 'O' then o_totalprice end as decimal(19,4))) as double) as t
     from orders group by o_custkey) on o_custkey = c_custkey"""
)
def default_fill(spark, sf):
    opened = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast(st.MONEY))
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum(opened).cast("double").alias("open_total")
    )
    joined = table(spark, sf, "customer").select("c_custkey").join(per, "c_custkey", "left")
    return sel.default_fill(sel.default_fill(joined, ["n_orders"]), ["open_total"], 0.0)


@query(f"select table_schema, table_name from ({st.tables_sql()}) where table_schema = 's1' and table_name like 'T1%' and table_name not like 'T%9'")
def discover_tables(spark, sf):
    from rowtide.operators.catalog import discover_tables as discover

    found = discover(st.tables(spark, sf), "s1", include=["t1*"], exclude=["T*9"])
    return found.select("table_schema", "table_name")


@query("select n_name, r_name, s_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey order by s_name")
def order_by_name(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    supplier = table(spark, sf, "supplier")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    joined = joined.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select("n_name", "r_name", "s_name").orderBy("s_name")


@query(f"select table_name, column_name, ordinal_position from ({st.columns_v1_sql()}) order by table_name, ordinal_position")
def order_by_ordinal(spark, sf):
    columns = st.columns_v1(spark, sf).select("table_name", "column_name", "ordinal_position")
    return columns.orderBy("table_name", "ordinal_position")


@query(
    """select user_id, selected, count(*) as n from (select user_id, event_type in ('view', 'click') and user_id % 10 <> 7 as selected
    from (select user_id, event_type from events)) group by all"""
)
def selected_flags(spark, sf):
    """The keep rule as a column, over names with the key in them."""
    rows = table(spark, sf, "events").withColumn("name", F.concat_ws("_", "event_type", "user_id"))
    keep = selected(F.col("name"), include=["view_*", "CLICK_*"], exclude=["*_7", "*7"])
    return rows.groupBy("user_id", keep.alias("selected")).agg(F.count("*").alias("n"))
