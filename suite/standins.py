"""Stand-in frames derived from the given tables, in Spark and in SQL.

The rules decide *what happens* to a row (inserted, updated, deleted, retyped …); every table is
read whole and the derived frames grow with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import spread
from suite.registry import table

# ---- change feeds --------------------------------------------------------------------------------


@dataclass(frozen=True)
class FeedSource:
    """A table a change feed is derived from."""

    table: str
    key: str
    owner: str
    status: str
    price: str

    @property
    def columns(self) -> list[str]:
        return [self.key, self.owner, self.status, self.price]


ORDERS = FeedSource("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
CUSTOMER = FeedSource("customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")

# op, status, amount added, seq offset, rows it happens to (as a rule on the key)
_CHANGES = (
    ("c", "N", 0, 0, "{k} % 10 = 9"),
    ("u", "U", 100, 1, "{k} % 5 = 0"),
    ("u", "V", 250, 2, "{k} % 15 = 0"),
    ("d", "D", 0, 3, "{k} % 7 = 3"),
    ("u", "S", 999, 0, "{k} % 35 = 10"),
    ("c", "R", 1, 4, "{k} % 21 = 3"),
)
_IN_BASE = "{k} % 10 <> 9"
MONEY = "decimal(19,4)"


def rows_of(spark: SparkSession, sf_dir: str, source: FeedSource) -> DataFrame:
    df = table(spark, sf_dir, source.table)
    return df.select(source.key, source.owner, source.status, F.col(source.price).cast(MONEY).alias(source.price))


def base(spark: SparkSession, sf_dir: str, source: FeedSource = ORDERS) -> DataFrame:
    return rows_of(spark, sf_dir, source).where(_IN_BASE.format(k=source.key))


def feed(spark: SparkSession, sf_dir: str, source: FeedSource = ORDERS) -> DataFrame:
    """All changes in one scan: each row yields the changes that happen to it."""

    def change(op: str, status: str, add: int, offset: int, rule: str) -> Column:
        row = F.struct(
            F.lit(op).alias("op"),
            (F.col(source.key) * 10 + offset).alias("seq"),
            F.lit(status).alias(source.status),
            (F.col(source.price) + F.lit(add).cast(MONEY)).cast(MONEY).alias(source.price),
        )
        return F.when(F.expr(rule.format(k=source.key)), row)

    happened = F.array_compact(F.array(*[change(*c) for c in _CHANGES]))
    exploded = rows_of(spark, sf_dir, source).select(source.key, source.owner, F.explode(happened).alias("_c"))
    return exploded.select(source.key, source.owner, f"_c.{source.status}", f"_c.{source.price}", "_c.op", "_c.seq")


def base_sql(source: FeedSource = ORDERS) -> str:
    s = source
    return (
        f"select {s.key}, {s.owner}, {s.status}, cast({s.price} as {MONEY}) as {s.price} "
        f"from {s.table} where {_IN_BASE.format(k=s.key)}"
    )


def feed_sql(source: FeedSource = ORDERS) -> str:
    s = source
    parts = [
        f"select {s.key}, {s.owner}, '{status}' as {s.status}, "
        f"cast(cast({s.price} as {MONEY}) + {add} as {MONEY}) as {s.price}, '{op}' as op, "
        f"cast({s.key} * 10 + {offset} as bigint) as seq from {s.table} where {rule.format(k=s.key)}"
        for op, status, add, offset, rule in _CHANGES
    ]
    return " union all ".join(parts)


def latest_sql(feed_name: str, key: str) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by seq desc) as rn "
        f"from {feed_name}) where rn = 1"
    )


def applied_sql(source: FeedSource = ORDERS, prefix: str = "") -> str:
    """Named subqueries ``base``, ``feed``, ``latest`` and ``final`` (the state after the feed)."""
    s, p = source, prefix
    cols = ", ".join(
        f"case when l.{s.key} is null then b.{c} else l.{c} end as {c}" for c in (s.owner, s.status, s.price)
    )
    return f"""
    {p}base as ({base_sql(s)}),
    {p}feed as ({feed_sql(s)}),
    {p}latest as ({latest_sql(f'{p}feed', s.key)}),
    {p}final as (
      select coalesce(l.{s.key}, b.{s.key}) as {s.key}, {cols}
      from {p}base b full outer join {p}latest l on b.{s.key} = l.{s.key}
      where l.op is null or l.op <> 'd')"""


# ---- catalogs: an order is a table, its line numbers are the columns -------------------------------

_TYPES = ("int", "varchar", "decimal", "datetime", "money", "NVarChar", "geography", "varbinary")
_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in _TYPES) + "]"
SCHEMA_OF = "concat('s', cast(l_orderkey % 4 as string))"
TABLE_OF = "concat('T', cast(l_orderkey as string))"


def _lines_sql() -> str:
    return (
        "select l_orderkey, l_linenumber, max(l_partkey) as pk, max(l_suppkey) as sk, "
        "cast(max(l_quantity) as bigint) as qty from lineitem group by l_orderkey, l_linenumber"
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per table and column, the lines of a table in one task: what is done by table or column has no need to move them.

    Order and line number are values of a group and no keys of it: a rule on them cannot be tried before lines are dealt out, so
    frames of other rules share one exchange.
    """
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    names = {"table_schema": F.expr(SCHEMA_OF), "table_name": F.expr(TABLE_OF)}
    lines = spread(rows, *names.values()).withColumns(names)
    return lines.groupBy(*names, F.col("l_linenumber").alias("line")).agg(
        F.max("l_orderkey").alias("l_orderkey"),
        F.max("l_linenumber").alias("l_linenumber"),
        F.max("l_partkey").alias("pk"),
        F.max("l_suppkey").alias("sk"),
        F.max("l_quantity").cast("bigint").alias("qty"),
    )


def _of_lines(lines: DataFrame, exprs) -> DataFrame:
    """The expressions over lines; the table's names are there already."""
    return lines.selectExpr(*_select([(n, n if n in lines.columns else e) for n, e in exprs], False))


# (output column, expression valid in both engines once {type} is put in)
_COLUMN_EXPRESSIONS = (
    ("table_schema", "concat('s', cast(l_orderkey % 4 as string))"),
    ("table_name", "concat('T', cast(l_orderkey as string))"),
    ("column_name", "concat('c', cast(l_linenumber as string))"),
    ("data_type", "{type}"),
    ("ordinal_position", "l_linenumber"),
    ("is_nullable", "case when sk % 3 = 0 then 'NO' else 'YES' end"),
    (
        "character_maximum_length",
        "cast(case when pk % 8 in (1, 5, 7) then (case when pk % 5 = 0 then -1 else pk % 200 end) end as int)",
    ),
    ("numeric_precision", "cast(case when pk % 8 = 2 then 18 end as int)"),
    ("numeric_scale", "cast(case when pk % 8 = 2 then sk % 5 end as int)"),
)
_PHYSICAL = (
    ("column_id", "l_linenumber"),
    ("is_computed", "pk % 11 = 0"),
    ("definition", "case when pk % 11 = 0 then concat('([Qty]*(', cast(qty as string), '))') end"),
)


def _typed(sql: bool) -> str:
    return f"{_TYPES_SQL}[cast(pk % 8 as int) + 1]" if sql else (
        f"element_at(array({', '.join(repr(t) for t in _TYPES)}), cast(pk % 8 as int) + 1)"
    )


def _select(exprs, sql: bool) -> list[str]:
    out = [f"{e.replace('{type}', _typed(sql))} as {n}" for n, e in exprs]
    return [e.replace(" as string)", " as varchar)") for e in out] if sql else out


def _names():
    return [e for e in _COLUMN_EXPRESSIONS if e[0] in ("table_schema", "table_name", "column_name")]


_V1 = "l_orderkey % 29 <> 0"


def columns_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_lines(_lines(spark, sf_dir).where(_V1), _COLUMN_EXPRESSIONS)


def columns_v1_sql() -> str:
    return f"select {', '.join(_select(_COLUMN_EXPRESSIONS, True))} from ({_lines_sql()}) where {_V1}"


# Version 2: tables gone and new, columns gone and added, types, nullability and lengths changed.
_V2 = "l_orderkey % 31 <> 0 and (l_orderkey + l_linenumber) % 17 <> 0"
_V2_ADDED = "l_orderkey % 31 <> 0 and (l_orderkey + l_linenumber) % 19 = 0"


def _v2_expressions():
    changed = dict(_COLUMN_EXPRESSIONS)
    changed["data_type"] = "case when (l_orderkey + l_linenumber) % 13 = 0 then 'bigint' else {type} end"
    changed["is_nullable"] = (
        "case when (sk % 3 = 0) <> ((l_orderkey + l_linenumber) % 23 = 0) then 'NO' else 'YES' end"
    )
    old = changed["character_maximum_length"]
    changed["character_maximum_length"] = f"cast({old} + case when l_orderkey % 9 = 4 then 10 else 0 end as int)"
    return tuple(changed.items())


def _v2_added_expressions():
    added = dict(_COLUMN_EXPRESSIONS)
    added["column_name"] = "concat('x', cast(l_linenumber as string))"
    added["ordinal_position"] = "cast(l_linenumber + 100 as int)"
    return tuple(added.items())


def columns_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    kept = _of_lines(lines.where(_V2), _v2_expressions())
    return kept.unionByName(_of_lines(lines.where(_V2_ADDED), _v2_added_expressions()))


def columns_v2_sql() -> str:
    kept = f"select {', '.join(_select(_v2_expressions(), True))} from ({_lines_sql()}) where {_V2}"
    new = f"select {', '.join(_select(_v2_added_expressions(), True))} from ({_lines_sql()}) where {_V2_ADDED}"
    return f"{kept} union all {new}"


def physical(spark: SparkSession, sf_dir: str) -> DataFrame:
    exprs = [*_names(), *[e for e in _PHYSICAL if e[0] != "definition"]]
    return _of_lines(_lines(spark, sf_dir), exprs)


def physical_sql() -> str:
    exprs = [*_names(), *[e for e in _PHYSICAL if e[0] != "definition"]]
    return f"select {', '.join(_select(exprs, True))} from ({_lines_sql()})"


def computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    exprs = [e for e in (*_names(), *_PHYSICAL) if e[0] not in ("column_name", "is_computed")]
    return _of_lines(_lines(spark, sf_dir).where("pk % 11 = 0"), exprs)


def computed_sql() -> str:
    exprs = [e for e in (*_names(), *_PHYSICAL) if e[0] not in ("column_name", "is_computed")]
    return f"select {', '.join(_select(exprs, True))} from ({_lines_sql()}) where pk % 11 = 0"


# Constraint names repeat over schemas on purpose.
_CONSTRAINT_NAME = "concat('PK_', cast(cast(floor(l_orderkey / 4) as bigint) as string))"
_CONSTRAINT = (
    ("constraint_name", _CONSTRAINT_NAME),
    ("table_schema", SCHEMA_OF),
    ("table_name", TABLE_OF),
    ("constraint_type", "case when l_orderkey % 6 = 5 then 'UNIQUE' else 'PRIMARY KEY' end"),
)
_USAGE = (("constraint_name", _CONSTRAINT_NAME), *_names())
_IN_KEY = "sk % 2 = 0"


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return orders.selectExpr(*_select(_CONSTRAINT, False))


def constraints_sql() -> str:
    return f"select {', '.join(_select(_CONSTRAINT, True))} from (select distinct l_orderkey from lineitem)"


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_lines(_lines(spark, sf_dir).where(_IN_KEY), _USAGE)


def usage_sql() -> str:
    return f"select {', '.join(_select(_USAGE, True))} from ({_lines_sql()}) where {_IN_KEY}"


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    exprs = [("table_schema", SCHEMA_OF), ("table_name", TABLE_OF)]
    orders = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return orders.selectExpr(*_select(exprs, False), "'BASE TABLE' as table_type")


def tables_sql() -> str:
    exprs = [("table_schema", SCHEMA_OF), ("table_name", TABLE_OF)]
    return f"select {', '.join(_select(exprs, True))}, 'BASE TABLE' as table_type from (select distinct l_orderkey from lineitem)"


# Keys of both versions: version 2 drops the second line number from some keys.
_KEYS_2 = f"{_IN_KEY} and not (l_orderkey % 10 = 3 and l_linenumber = 2)"


def keys(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    rule = _IN_KEY if version == 1 else _KEYS_2
    return _of_lines(_lines(spark, sf_dir).where(rule), _names())


def keys_sql(version: int = 1) -> str:
    rule = _IN_KEY if version == 1 else _KEYS_2
    return f"select {', '.join(_select(_names(), True))} from ({_lines_sql()}) where {rule}"


# ---- activity ------------------------------------------------------------------------------------

HIGH, LOW = 44, 36  # write thresholds that give all tiers on the events
P_HIGH, P_LOW = 56, 46  # the same for the part counters


def index_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    view, click, write = kind == "view", kind == "click", kind.isin("purchase", "signup", "error")
    none = F.lit(None).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity"),
        view.cast("bigint").alias("user_seeks"),
        click.cast("bigint").alias("user_scans"),
        F.lit(0).cast("bigint").alias("user_lookups"),
        write.cast("bigint").alias("user_updates"),
        F.when(view, ts).otherwise(none).alias("last_user_seek"),
        F.when(click, ts).otherwise(none).alias("last_user_scan"),
        F.when(write, ts).otherwise(none).alias("last_user_update"),
    )


ROLLUP_SQL = """
  select user_id as entity,
         cast(sum(case when event_type in ('view', 'click') then 1 else 0 end) as bigint) as total_reads,
         cast(sum(case when event_type in ('purchase', 'signup', 'error') then 1 else 0 end) as bigint) as total_updates,
         cast(count(*) as bigint) as total_io,
         max(case when event_type = 'view' then ts end) as last_seek,
         max(case when event_type = 'click' then ts end) as last_scan,
         max(case when event_type in ('purchase', 'signup', 'error') then ts end) as last_update
  from events group by user_id"""

RATIO_SQL = """case when total_updates = 0 and total_reads > 0 then 999999.0::double
     when total_updates > 0 then total_reads::double / total_updates::double else 0.0::double end"""


def tier_sql(metric: str, high: int = HIGH, low: int = LOW) -> str:
    return f"case when {metric} >= {high} then 'high' when {metric} >= {low} then 'medium' else 'low' end"


COVERAGE_SQL = f"""
  select entity, total_reads, total_updates, total_io, last_activity, row_count,
         {RATIO_SQL} as read_write_ratio,
         case when not seen then 'low' else {tier_sql('total_updates')} end as category
  from (
    select c_custkey as entity, u.entity is not null as seen,
           coalesce(total_reads, 0) as total_reads, coalesce(total_updates, 0) as total_updates,
           coalesce(total_io, 0) as total_io, greatest(last_seek, last_scan, last_update) as last_activity,
           coalesce(o.n, 0) as row_count
    from customer left join ({ROLLUP_SQL}) u on u.entity = c_custkey
    left join (select o_custkey, cast(count(*) as bigint) as n from orders group by o_custkey) o on o_custkey = c_custkey)"""


def operational(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("bigint")
    returned = F.col("l_returnflag").isin("R", "A").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("entity"),
        F.lit(1).alias("index_id"),
        F.col("l_quantity").cast("bigint").alias("range_scan_count"),
        line.alias("singleton_lookup_count"),
        F.lit(1).cast("bigint").alias("leaf_insert_count"),
        returned.alias("leaf_update_count"),
        F.lit(0).cast("bigint").alias("leaf_delete_count"),
        (line * 2).alias("row_lock_count"),
        line.alias("page_lock_count"),
    )


OPERATIONAL_SQL = """
  select l_partkey as entity,
         cast(sum(cast(l_quantity as bigint) + l_linenumber) as bigint) as total_reads,
         cast(sum(1 + case when l_returnflag in ('R', 'A') then 1 else 0 end) as bigint) as total_updates,
         cast(sum(l_linenumber * 3) as bigint) as locks
  from lineitem group by l_partkey"""


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage counters per part and line number: many partitions per entity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("entity"),
        F.lit(1).alias("index_id"),
        F.col("l_linenumber").alias("partition_no"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.col("l_linenumber").cast("bigint").alias("used_page_count"),
        (F.col("l_linenumber").cast("bigint") + 1).alias("reserved_page_count"),
    )


STORAGE_SQL = """
  select l_partkey as entity, cast(count(*) as bigint) as row_count,
         cast(sum(l_linenumber) * 8 as bigint) as used_kb, cast(sum(l_linenumber + 1) * 8 as bigint) as reserved_kb
  from lineitem group by l_partkey"""


# ---- named entities for job planning ---------------------------------------------------------------

_NAME = """case when p_partkey % 97 = 0 then concat('Q', lower(translate(cast(p_partkey as string), '0123456789', 'abcdefghij')), 'Zone')
     when p_partkey % 4 = 0 then concat(p_type, 'Item', cast(p_partkey as string))
     when p_partkey % 4 = 1 then concat(upper(substring(p_name, 1, 1)), substring(replace(p_name, ' ', 'W'), 2), cast(p_partkey as string))
     when p_partkey % 4 = 2 then concat(upper(substring(p_name, 1, 1)), substring(replace(p_name, ' ', '_'), 2), cast(p_partkey as string))
     else concat(p_name, cast(p_partkey as string)) end"""


def named_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity of parts under table-like names, with tier; one row per part."""
    from rowtide.operators import activity as act

    rolled = act.with_lock_weight(act.operational_rollup(operational(spark, sf_dir), "entity")).drop("locks")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entity"),
        F.lit("sales").alias("schema_name"),
        F.expr(_NAME).alias("name"),
        F.col("p_size").cast("bigint").alias("row_count"),
    )
    zeroed = parts.join(rolled, "entity", "left").na.fill(0, ["total_reads", "total_updates", "total_io"])
    return act.with_ratio_and_tier(zeroed, P_HIGH, P_LOW).drop("entity")


NAMED_SQL = f"""
  select schema_name, name, row_count, total_reads, total_updates, total_io,
         {RATIO_SQL} as read_write_ratio, {tier_sql('total_updates', P_HIGH, P_LOW)} as category
  from (
    select 'sales' as schema_name, {_NAME.replace(' as string)', ' as varchar)')} as name, cast(p_size as bigint) as row_count,
           coalesce(total_reads, 0) as total_reads, coalesce(total_updates, 0) as total_updates,
           coalesce(total_reads + total_updates + locks // 10, 0) as total_io
    from part left join ({OPERATIONAL_SQL}) o on o.entity = p_partkey)"""

DOMAIN_SQL = """lower(coalesce(nullif(regexp_extract(name, '^([A-Z]{2,})[A-Z][a-z]', 1), ''),
     nullif(regexp_extract(name, '^([A-Z]{2,})$', 1), ''), nullif(regexp_extract(name, '^([A-Z][a-z]+)', 1), ''), 'misc'))"""

GROUPED_SQL = f"""
  select * exclude (pool, rn), concat(pool, '_group', cast((rn - 1) // 10 + 1 as varchar)) as group_name
  from (select *, row_number() over (partition by pool order by name) as rn
        from (select *, case when count(*) over (partition by domain) > 1 then domain else 'medium_misc' end as pool
              from (select *, {DOMAIN_SQL} as domain from ({NAMED_SQL}))))"""
