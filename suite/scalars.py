"""Scalar functions (survey group L), each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions import text
from rowtide.functions.measures import or_zero, safe_number
from suite import standins as st
from suite.registry import query, table


@query("select distinct lower(c_mktsegment) as segment, lower(o_orderpriority) as priority from customer join orders on o_custkey = c_custkey")
def fn_lower(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    joined = customer.join(orders, customer.c_custkey == orders.o_custkey)
    return joined.select(F.lower("c_mktsegment").alias("segment"), F.lower("o_orderpriority").alias("priority")).distinct()


@query("""select p_partkey, regexp_replace(p_name, '[aeiou]', '*', 'g') as starred, replace(p_name, ' ', '-') as dashed, replace(replace(p_name, ' ', '-'), '-', '_') as name from part""")
def fn_regex_replace(spark, sf):
    dashed = F.replace("p_name", F.lit(" "), F.lit("-"))
    return table(spark, sf, "part").select(
        "p_partkey", F.regexp_replace("p_name", "[aeiou]", "*").alias("starred"), dashed.alias("dashed"), text.identifier(dashed).alias("name")
    )


@query("""select event_id, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as bigint) as k, regexp_matches(props, '7') as has_seven from events""")
def fn_regex_extract(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("bigint").alias("k"), F.col("props").rlike("7").alias("has_seven")
    )


@query("select p_partkey, concat('DECIMAL(', p_size + 10, ',', p_size % 10, ') of ', p_brand) as filled from part")
def fn_template_fill(spark, sf):
    values = {"precision": F.col("p_size") + 10, "scale": F.col("p_size") % 10, "brand": F.col("p_brand")}
    filled = text.fill_template(F.lit("DECIMAL({precision},{scale}) of {brand}"), values)
    return table(spark, sf, "part").select("p_partkey", filled.alias("filled"))


@query("select s_suppkey, concat(s_name, '_', n_name) as joined, concat_ws(', ', s_name, nullif(n_name, 'NATION_0'), cast(s_suppkey as varchar)) as listed from supplier join nation on s_nationkey = n_nationkey")
def fn_concat(spark, sf):
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return joined.select(
        "s_suppkey",
        F.concat("s_name", F.lit("_"), "n_name").alias("joined"),
        F.concat_ws(", ", "s_name", F.nullif("n_name", F.lit("NATION_0")), F.col("s_suppkey").cast("string")).alias("listed"),
    )


@query("select l_orderkey, l_linenumber, coalesce(nullif(l_quantity, 1.0), 0) as quantity, coalesce(nullif(l_returnflag, 'N'), '?') as flag from lineitem")
def fn_null_default(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        or_zero(F.nullif("l_quantity", F.lit(1.0))).alias("quantity"),
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("?")).alias("flag"),
    )


@query("select o_orderkey, o_orderkey // 10 as tenth, cast(floor(o_totalprice / 1000) as bigint) as thousands from orders")
def fn_floor_divide(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.call_function("div", F.col("o_orderkey"), F.lit(10)).alias("tenth"),
        F.floor(F.col("o_totalprice") / 1000).alias("thousands"),
    )


@query("select o_orderkey, coalesce(try_cast(substr(o_orderpriority, 1, 1) as bigint), 0) as rank, coalesce(try_cast(o_orderstatus as bigint), 0) as none from orders")
def fn_safe_number(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", safe_number(F.substring("o_orderpriority", 1, 1)).alias("rank"), safe_number(F.col("o_orderstatus")).alias("none")
    )


@query(
    """select o_orderkey, format('{:,}', cast(o_orderkey * 12345 as bigint)) as grouped, lpad(format('{:,}', o_orderkey), 12, ' ') as left_padded,
    rpad(o_orderstatus, 5, ' ') as right_padded, cast(cast(o_totalprice as decimal(38,2)) as varchar) as fixed from orders"""
)
def fn_number_format(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.grouped_number(key * 12345).alias("grouped"),
        F.lpad(text.grouped_number(key), 12, " ").alias("left_padded"),
        F.rpad("o_orderstatus", 5, " ").alias("right_padded"),
        text.fixed2(F.col("o_totalprice")).alias("fixed"),
    )


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as iso from events union all select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') from orders")
def fn_iso_timestamp(spark, sf):
    events = table(spark, sf, "events").select("event_id", text.iso_millis(F.col("ts")).alias("iso"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), text.iso_millis(F.col("o_orderdate")).alias("iso"))
    return events.unionByName(orders)


@query("select doc_id, sha256(text) as digest from documents")
def fn_sha256(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, concat('{"event_id":', event_id, ',"event_type":"', event_type, '"}') as encoded from events""")
def fn_json(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k bigint").getField("k").alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("encoded"),
    )


@query(
    """select p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ' ') as sorted, string_split(p_name, ' ')[1] as first,
    list_contains(string_split(p_name, ' '), 'red') as has_red, array_to_string(string_split(p_name, ' ')[2:3], ' ') as rest from part"""
)
def fn_array(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_join(F.array_sort(words), " ").alias("sorted"),
        F.element_at(words, 1).alias("first"),
        F.array_contains(words, "red").alias("has_red"),
        F.array_join(F.slice(words, 2, 2), " ").alias("rest"),
    )


@query("select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'unknown' end as status from orders")
def fn_map_lookup(spark, sf):
    words = F.create_map(F.lit("F"), F.lit("finished"), F.lit("O"), F.lit("open"))
    found = F.coalesce(F.try_element_at(words, F.col("o_orderstatus")), F.lit("unknown"))
    return table(spark, sf, "orders").select("o_orderkey", found.alias("status"))


@query(f"select entity, greatest(last_seek, last_update) as newest, last_seek > last_update as read_last from ({st.ROLLUP_SQL})")
def fn_date_compare(spark, sf):
    from rowtide.operators.activity import activity_rollup

    rolled = activity_rollup(st.index_usage(spark, sf), "entity")
    return rolled.select(
        "entity", F.greatest("last_seek", "last_update").alias("newest"), (F.col("last_seek") > F.col("last_update")).alias("read_last")
    )
