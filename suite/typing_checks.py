"""Type conversion and key quality (survey groups I and N)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from rowtide.functions.conversions import ColumnSpec, converted, register_conversion, unregister_conversion
from rowtide.operators import changes as ch
from rowtide.operators import quality
from suite import standins as st
from suite.registry import query, table

ORDER_SPECS = [
    ColumnSpec("o_orderkey", "bigint", nullable=False),
    ColumnSpec("o_totalprice", "money"),
    ColumnSpec("o_orderdate", "datetime"),
    ColumnSpec("o_orderpriority", "varchar", length=6, truncate=True),
    ColumnSpec("o_orderstatus", "char", length=3),
]


@query(
    """select o_orderkey, o_custkey, rpad(o_orderstatus, 3, ' ') as o_orderstatus, cast(o_totalprice as decimal(19,4)) as o_totalprice,
    date_trunc('milliseconds', o_orderdate) as o_orderdate, substr(o_orderpriority, 1, 6) as o_orderpriority from orders"""
)
def conform(spark, sf):
    return quality.conform(table(spark, sf, "orders"), ORDER_SPECS)


@query(
    """select event_id, date_trunc('milliseconds', ts) as as_datetime, date_trunc('second', ts) as as_smalldatetime,
    to_timestamp(0) at time zone 'UTC' + to_microseconds((epoch_us(ts) // 10000) * 10000) as as_datetime2,
    strftime(ts, '%H:%M:%S.%g') as as_time, cast(ts as date) as as_date, cast(user_id as smallint) as as_smallint,
    case when user_id between 0 and 255 then cast(user_id as smallint) end as as_tinyint, cast(value as float) as as_real,
    event_type = 'error' as as_bit from events"""
)
def conform_times(spark, sf):
    events = table(spark, sf, "events")
    ts, user = F.col("ts"), F.col("user_id")

    def as_type(value, source_type: str, **kw):
        return converted(value, ColumnSpec("x", source_type, **kw)).alias(f"as_{source_type}")

    return events.select(
        "event_id",
        as_type(ts, "datetime"),
        as_type(ts, "smalldatetime"),
        as_type(ts, "datetime2", scale=2),
        as_type(ts, "time", scale=3),
        as_type(ts, "date"),
        as_type(user, "smallint"),
        as_type(user, "tinyint"),
        as_type(F.col("value"), "real"),
        as_type((F.col("event_type") == "error").cast("string"), "bit"),
    )


LINE_SPECS = [
    ColumnSpec("l_quantity", "decimal", precision=3, scale=1),
    ColumnSpec("l_extendedprice", "decimal", precision=6, scale=2),
    ColumnSpec("l_returnflag", "varchar", length=1),
    ColumnSpec("l_shipdate", "smalldatetime", nullable=False),
    ColumnSpec("l_partkey", "int", nullable=False),
    ColumnSpec("l_linestatus", "geography"),
]


def _reported(name: str, kind: str, failed: str = "false", mapped: str = "true", long: str = "false") -> str:
    return (
        f"select '{name}' as column_name, '{kind}' as source_type, {mapped} as is_mapped, cast(count(*) as bigint) as n_rows, "
        f"cast(count(*) filter ({name} is null) as bigint) as n_nulls, cast(count(*) filter ({failed}) as bigint) as failed_cast, "
        f"cast(0 as bigint) as null_in_not_null, cast(count(*) filter ({long}) as bigint) as over_length from lineitem"
    )


@query(
    " union all ".join(
        [
            _reported("l_quantity", "decimal", "abs(round(l_quantity, 1)) >= 100"),
            _reported("l_extendedprice", "decimal", "abs(round(l_extendedprice, 2)) >= 10000"),
            _reported("l_returnflag", "varchar", long="length(l_returnflag) > 1"),
            _reported("l_shipdate", "smalldatetime"),
            _reported("l_partkey", "int"),
            _reported("l_linestatus", "geography", mapped="false"),
        ]
    )
)
def conformance_report(spark, sf):
    return quality.conformance_report(table(spark, sf, "lineitem"), LINE_SPECS)


CUSTOMER_SPECS = [
    ColumnSpec("c_name", "char", length=17),
    ColumnSpec("c_acctbal", "decimal", precision=5, scale=2),
    ColumnSpec("c_mktsegment", "varchar", length=9),
]


@query(
    """select c_custkey, concat_ws(',', case when abs(round(c_acctbal, 2)) >= 1000 then 'c_acctbal:failed_cast' end,
      case when length(c_mktsegment) > 9 then 'c_mktsegment:over_length' end) as reasons,
      case when abs(round(c_acctbal, 2)) < 1000 and length(c_mktsegment) <= 9 then cast(cast(c_acctbal as decimal(9,2)) as double) end as balance
    from (select c_custkey, c_acctbal, case when c_custkey % 4 = 0 then concat(c_mktsegment, 's') else c_mktsegment end as c_mktsegment from customer)"""
)
def quarantine(spark, sf):
    longer = F.when(F.col("c_custkey") % 4 == 0, F.concat("c_mktsegment", F.lit("s"))).otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").withColumn("c_mktsegment", longer)
    specs = [s for s in CUSTOMER_SPECS if s.name != "c_name"]
    valid, rejected = quality.quarantine(rows, specs)
    kept = valid.select("c_custkey", F.lit("").alias("reasons"), F.col("c_acctbal").cast("double").alias("balance"))
    refused = rejected.select(
        "c_custkey", F.array_join("reasons", ",").alias("reasons"), F.lit(None).cast("double").alias("balance")
    )
    return kept.unionByName(refused)


@query(
    """with g as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all)
    select cast(sum(n) as bigint) as n_rows, cast(count(*) as bigint) as n_keys, cast(0 as bigint) as null_key_rows,
      cast(count(*) filter (n > 1) as bigint) as duplicate_keys, cast(sum(n - 1) as bigint) as surplus_rows,
      sum(n - 1) = 0 as is_unique from g"""
)
def key_quality(spark, sf):
    return quality.key_quality(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """select * from (select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey from lineitem)
    qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1"""
)
def dedupe_by_key(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    return ch.dedupe_by_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("select doc_id, hex(encode(text)) as hex_text, length(hex(encode(text))) // 2 as n_bytes, text from documents")
def hex_binary(spark, sf):
    docs = table(spark, sf, "documents")
    hexed = converted(F.col("text").cast("binary"), ColumnSpec("text", "varbinary", length=-1))
    out = docs.select("doc_id", hexed.alias("hex_text"))
    return out.select(
        "doc_id",
        "hex_text",
        F.length(F.unhex("hex_text")).cast("bigint").alias("n_bytes"),
        F.decode(F.unhex("hex_text"), "utf-8").alias("text"),
    )


@query(
    """select o_custkey, cast(sum(cast(o_totalprice as decimal(19,4))) as double) as total,
    cast(sum(cast(cast(o_totalprice as decimal(19,4)) * 3 as decimal(19,4))) as double) as tripled from orders group by o_custkey"""
)
def money_decimal(spark, sf):
    price = converted(F.col("o_totalprice"), ColumnSpec("o_totalprice", "money"))
    tripled = (price * 3).cast(st.MONEY)
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(price).cast("double").alias("total"), F.sum(tripled).cast("double").alias("tripled")
    )


@query("select c_custkey, lpad(cast(c_nationkey as varchar), 4, '0') as c_nationkey, lower(c_mktsegment) as c_mktsegment from customer", name="register_conversion")
def register_conversion_native(spark, sf):
    register_conversion("nation_code", lambda c, spec: F.lpad(c.cast("string"), spec.length, "0"))
    register_conversion("segment", lambda c, spec: F.lower(c))
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    specs = [ColumnSpec("c_nationkey", "nation_code", length=4), ColumnSpec("c_mktsegment", "segment")]
    out = quality.conform(rows, specs)
    for name in ("nation_code", "segment"):
        unregister_conversion(name)
    return out


@query("select doc_id, nfc_normalize(text) as text from documents", name="pandas_conversion")
def register_conversion_pandas(spark, sf):
    """A conversion given as an Arrow function, as no native one puts text in composed form."""

    @F.pandas_udf("string")
    def composed(values: pd.Series) -> pd.Series:
        return values.str.normalize("NFC")

    register_conversion("composed", lambda c, spec: composed(c))
    rows = table(spark, sf, "documents").select("doc_id", "text")
    out = quality.conform(rows, [ColumnSpec("text", "composed")])
    unregister_conversion("composed")
    return out
