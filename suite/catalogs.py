"""Joins over catalogs, keys and their order, schema change (survey groups C, F-2…F-4, H, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.operators import catalog as cat
from rowtide.operators import changes as ch
from rowtide.operators import diff as df_
from rowtide.operators import lookup
from rowtide.session import workspace
from rowtide.sources import sinks
from suite import standins as st
from suite.registry import query, table
from suite.replication import KEY, OUT, shown

NAMES = "table_schema, table_name, column_name"


@query(
    f"""select c.table_schema, c.table_name, c.column_name, c.data_type, p.column_id, p.is_computed
    from ({st.columns_v1_sql()}) c join ({st.physical_sql()}) p using (table_schema, table_name, column_name)"""
)
def join_inner_multikey(spark, sf):
    joined = cat.join_physical(st.columns_v1(spark, sf), st.physical(spark, sf))
    return joined.select("table_schema", "table_name", "column_name", "data_type", "column_id", "is_computed")


@query(
    f"""select p.table_schema, p.table_name, p.column_name, coalesce(d.definition, '') as definition
    from ({st.physical_sql()}) p left join ({st.computed_sql()}) d using (table_schema, table_name, column_id)"""
)
def join_left_optional(spark, sf):
    joined = cat.join_definitions(st.physical(spark, sf), st.computed(spark, sf))
    return joined.select("table_schema", "table_name", "column_name", F.coalesce("definition", F.lit("")).alias("definition"))


@query(
    f"""select k.table_schema, k.constraint_name, k.table_name, u.column_name from ({st.constraints_sql()}) k
    join ({st.usage_sql()}) u using (table_schema, constraint_name) where constraint_type = 'PRIMARY KEY'"""
)
def join_constraints(spark, sf):
    found = cat.primary_keys(st.constraints(spark, sf), st.usage(spark, sf))
    return found.select("table_schema", "constraint_name", "table_name", "column_name")


POSITION_SQL = f"""
  select k.table_schema, k.table_name, k.column_name, coalesce(c.ordinal_position, 999) as ordinal_position
  from ({st.keys_sql()}) k left join ({st.columns_v1_sql()}) c using (table_schema, table_name, column_name)"""


@query(
    f"""select *, cast(row_number() over (partition by table_schema, table_name order by ordinal_position, column_name) as int)
    as key_position from ({POSITION_SQL})"""
)
def key_by_position(spark, sf):
    return cat.key_by_position(st.keys(spark, sf), st.columns_v1(spark, sf))


@query(
    f"""select table_schema, table_name, column_name as chunk_column from (select *, row_number() over
    (partition by table_schema, table_name order by ordinal_position, column_name) as rn from ({POSITION_SQL})) where rn = 1"""
)
def first_key_column(spark, sf):
    return cat.first_key_column(st.keys(spark, sf), st.columns_v1(spark, sf))


@query(
    f"""with k as ({st.keys_sql()}), t as ({st.tables_sql()}), c as ({st.columns_v1_sql()}),
    f as (select table_schema, table_name, arg_min(column_name, ordinal_position) as first from c group by all)
    select {NAMES}, 'declared' as key_source from k union all
    select t.table_schema, t.table_name, coalesce(first, 'id'),
           case when first is null then 'default' else 'first_column' end
    from t left join f using (table_schema, table_name)
    where (t.table_schema, t.table_name) not in (select (table_schema, table_name) from k)"""
)
def fallback_key(spark, sf):
    return cat.fallback_key(st.tables(spark, sf), st.keys(spark, sf), st.columns_v1(spark, sf))


CUSTOM = [("geography", "GEO", "GEO"), ("int", "INTEGER", "INTEGER")]

_LENGTH = "case when character_maximum_length = -1 then 65535 else character_maximum_length end"
TYPES_SQL = f"""
  select *, lower(data_type) as source_type, case lower(data_type)
    when 'int' then 'INTEGER' when 'bigint' then 'BIGINT' when 'geography' then 'GEO' when 'datetime' then 'DATETIME'
    when 'money' then 'DECIMAL(19,4)' when 'varbinary' then 'VARBINARY'
    when 'varchar' then concat('VARCHAR(', coalesce({_LENGTH}, 255), ')')
    when 'nvarchar' then concat('VARCHAR(', coalesce({_LENGTH}, 255), ')')
    when 'decimal' then concat('DECIMAL(', coalesce(numeric_precision, 10), ',', coalesce(numeric_scale, 0), ')') end as target_type,
  case lower(data_type) when 'datetime' then 'TIMESTAMP(3)'
    when 'varbinary' then concat('VARCHAR(', coalesce(nullif({_LENGTH}, 0), 127) * 2, ')') end as other_stream
  from ({st.columns_v2_sql()})"""


@query(f"select {NAMES}, source_type, coalesce(other_stream, target_type) as stream_type, target_type, true as is_mapped from ({TYPES_SQL})")
def type_map_join(spark, sf):
    mapped = cat.map_types(st.columns_v2(spark, sf), CUSTOM)
    return mapped.select("table_schema", "table_name", "column_name", "source_type", "stream_type", "target_type", "is_mapped")


@query(
    f"""select lower(data_type) as source_type, cast(count(*) as bigint) as n_columns,
    any_value(case lower(data_type) when 'geography' then 'STRING' when 'int' then 'INT' when 'bigint' then 'BIGINT'
      when 'varchar' then 'VARCHAR({{maxLength}})' when 'nvarchar' then 'VARCHAR({{maxLength}})'
      when 'decimal' then 'DECIMAL({{precision}},{{scale}})' when 'datetime' then 'DATETIME'
      when 'money' then 'DECIMAL(19,4)' when 'varbinary' then 'VARBINARY' end) as target_type,
    any_value(lower(data_type) <> 'geography') as is_mapped from ({st.columns_v2_sql()}) group by 1"""
)
def type_usage(spark, sf):
    return cat.type_usage(st.columns_v2(spark, sf))


@query(
    f"""with d as (select table_schema, table_name, concat('job', cast(column_id % 3 as varchar)) as job from ({st.computed_sql()})),
    j as (select table_schema, table_name, job, count(*) as job_columns from d group by all)
    select *, cast(sum(job_columns) over (partition by table_schema, table_name) as bigint) as table_columns,
           count(*) over (partition by table_schema, table_name) as table_jobs from j"""
)
def derived_columns_by_table(spark, sf):
    job = F.concat(F.lit("job"), F.pmod("column_id", F.lit(3)).cast("string"))
    return cat.derived_by_table(st.computed(spark, sf).withColumn("job", job))


@query(
    f"""select distinct table_schema, table_name from ({st.columns_v2_sql()}) where (table_schema, table_name) not in
    (select (table_schema, table_name) from ({st.columns_v1_sql()}))"""
)
def new_entities_anti(spark, sf):
    now, before = (c(spark, sf).select(*cat.TABLE).distinct() for c in (st.columns_v2, st.columns_v1))
    return cat.new_entities(now, before, cat.TABLE)


@query(
    """with m as (select * from (values ('1-URGENT', 'fast', 1), ('1-URGENT', 'slow', 2), ('2-HIGH', 'fast', 3),
      ('5-LOW', 'idle', 5), ('5-LOW', 'slow', 4)) m(o_orderpriority, lane, priority))
    select o_orderkey, o_orderpriority, coalesce(lane, 'none') as lane from orders left join
    (select o_orderpriority, arg_min(lane, priority) as lane from m group by 1) using (o_orderpriority)"""
)
def lookup_first_match(spark, sf):
    mapping = spark.createDataFrame(
        [("1-URGENT", "fast", 1), ("1-URGENT", "slow", 2), ("2-HIGH", "fast", 3), ("5-LOW", "idle", 5), ("5-LOW", "slow", 4)],
        "o_orderpriority string, lane string, priority int",
    )
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    found = lookup.lookup_first_match(rows, mapping, ["o_orderpriority"])
    return found.select("o_orderkey", "o_orderpriority", F.coalesce("lane", F.lit("none")).alias("lane"))


@query(
    """select user_id, event_type, any_value(target) as target from (
      select user_id, event_type, concat('custom-', max(event_id)) as target from events where event_type in ('view', 'error') group by 1, 2
      union all select user_id, event_type, concat('default-', min(event_id)) from events where event_type <> 'view' and
        not (event_type = 'error') group by 1, 2) group by 1, 2"""
)
def union_with_priority(spark, sf):
    """Defaults for all but views, custom entries for views and errors: custom wins on errors."""
    events = table(spark, sf, "events").groupBy("user_id", "event_type")
    default = events.agg(F.concat(F.lit("default-"), F.min("event_id")).alias("target")).where("event_type <> 'view'")
    custom = events.agg(F.concat(F.lit("custom-"), F.max("event_id")).alias("target")).where(
        F.col("event_type").isin("view", "error")
    )
    return lookup.union_with_priority(default, custom, ["user_id", "event_type"])


@query(
    f"""select {NAMES}, case when not coalesce(o, false) then '+' when not coalesce(n, false) then '-' else '=' end as side
    from (select {NAMES}, true as o from ({st.columns_v1_sql()})) full outer join
         (select {NAMES}, true as n from ({st.columns_v2_sql()})) using (table_schema, table_name, column_name)"""
)
def diff_full_outer(spark, sf):
    return df_.match_sides(st.columns_v1(spark, sf), st.columns_v2(spark, sf), cat.COLUMN)


# ---- H: set operations -----------------------------------------------------------------------------

_VERSIONS = f"with {st.applied_sql()}"


def versions(spark, sf):
    base = st.base(spark, sf)
    return base, ch.apply_changes(base, st.feed(spark, sf), KEY)


@query(f"{_VERSIONS} select o_orderkey from final except select o_orderkey from base")
def keys_added(spark, sf):
    return df_.keys_added(*versions(spark, sf), KEY)


@query(f"{_VERSIONS} select o_orderkey from base except select o_orderkey from final")
def keys_removed(spark, sf):
    return df_.keys_removed(*versions(spark, sf), KEY)


@query(f"{_VERSIONS} select o_orderkey from base intersect select o_orderkey from final")
def keys_common(spark, sf):
    return df_.keys_common(*versions(spark, sf), KEY)


# ---- J: change detection ---------------------------------------------------------------------------

_PAIRED = f"""
  select coalesce(o.table_schema, n.table_schema) as table_schema, coalesce(o.table_name, n.table_name) as table_name,
         coalesce(o.column_name, n.column_name) as column_name, o.table_name is null as is_new, n.table_name is null as is_gone,
         o.data_type as ot, n.data_type as nt, o.is_nullable as onull, n.is_nullable as nnull,
         o.character_maximum_length as ol, n.character_maximum_length as nl, o.numeric_precision as op, n.numeric_precision as np,
         o.numeric_scale as os, n.numeric_scale as ns, o.ordinal_position as oo, n.ordinal_position as no
  from ({st.columns_v1_sql()}) o full outer join ({st.columns_v2_sql()}) n
    on o.table_schema = n.table_schema and o.table_name = n.table_name and o.column_name = n.column_name"""


def _attribute_sql(kind: str, old: str, new: str) -> str:
    shown_old, shown_new, title = f"coalesce(cast({old} as varchar), 'none')", f"coalesce(cast({new} as varchar), 'none')", f"Changed {kind}"
    if kind == "type":
        title = "Modified column"
    if kind == "nullability":
        title = "Nullability changed"
        shown_old = f"case when {old} = 'YES' then 'NULL' else 'NOT NULL' end"
        shown_new = f"case when {new} = 'YES' then 'NULL' else 'NOT NULL' end"
    return (
        f"select {NAMES}, '{kind}' as kind, cast({old} as varchar) as old_value, cast({new} as varchar) as new_value, "
        f"concat('~ {title}: ', column_name, ' (', {shown_old}, ' -> ', {shown_new}, ')') as message "
        f"from paired where not is_new and not is_gone and {old} is distinct from {new}"
    )


_ATTRIBUTES = (
    ("type", "ot", "nt"),
    ("nullability", "onull", "nnull"),
    ("length", "ol", "nl"),
    ("precision", "op", "np"),
    ("scale", "os", "ns"),
    ("ordinal", "oo", "no"),
)
DIFF_SQL = f"""
  select {NAMES}, 'added' as kind, cast(null as varchar) as old_value, nt as new_value,
         concat('+ Added column: ', column_name, ' (', nt, ')') as message from paired where is_new
  union all select {NAMES}, 'removed', ot, null, concat('- Removed column: ', column_name) from paired where is_gone
  union all {' union all '.join(_attribute_sql(*a) for a in _ATTRIBUTES)}"""


@query(f"with paired as ({_PAIRED}) {DIFF_SQL}")
def schema_diff(spark, sf):
    return df_.schema_diff(st.columns_v1(spark, sf), st.columns_v2(spark, sf))


@query(f"with paired as ({_PAIRED}), d as ({DIFF_SQL}) select table_schema, table_name, kind, count(*) as n_changes from d group by all")
def change_summary(spark, sf):
    return df_.change_summary(df_.schema_diff(st.columns_v1(spark, sf), st.columns_v2(spark, sf)))


def _field(c: str) -> str:
    return f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"


_SUMMED_DIGEST = " || '-' || ".join(f"cast(sum(('0x' || substr(h, {at}, 16))::ubigint::decimal(38,0)) as varchar)" for at in (1, 17, 33, 49))


def _checksum_sql(columns: str, keys: str) -> str:
    """The checksum rule in SQL, over columns without formula and keys with their position."""
    attributes = (
        "kind column_name data_type ordinal_position is_nullable character_maximum_length numeric_precision numeric_scale"
    ).split()
    positions = f"""select table_schema, table_name, column_name, row_number() over (partition by table_schema, table_name
      order by column_name) as p from ({keys})"""
    rows = f"""select table_schema, table_name, 'column' as kind, column_name, data_type, ordinal_position, is_nullable,
        character_maximum_length, numeric_precision, numeric_scale from ({columns})
      union all select table_schema, table_name, 'key', column_name, null, p, null, null, null, null from ({positions})"""
    hashed = f"select table_schema, table_name, sha256(concat({', '.join(_field(a) for a in attributes)})) as h from ({rows})"
    return f"""select table_schema, table_name,
      sha256(concat(cast(count(*) as varchar), '-', {_SUMMED_DIGEST})) as checksum from ({hashed}) group by all"""


def _placed_keys(spark, sf, version: int):
    order = st.physical(spark, sf).withColumnRenamed("column_id", "ordinal_position")
    return cat.key_by_position(st.keys(spark, sf, version), order, by=cat.TABLE)


def _checksums(spark, sf, version: int):
    columns = (st.columns_v1, st.columns_v2)[version - 1](spark, sf)
    return cat.schema_checksum(columns, _placed_keys(spark, sf, version), by=cat.TABLE)


@query(_checksum_sql(st.columns_v1_sql(), st.keys_sql(1)))
def schema_checksum(spark, sf):
    return _checksums(spark, sf, 1)


@query(
    f"""select o.table_schema, o.table_name, o.checksum as old_checksum, n.checksum as new_checksum
    from ({_checksum_sql(st.columns_v1_sql(), st.keys_sql(1))}) o join ({_checksum_sql(st.columns_v2_sql(), st.keys_sql(2))}) n
    using (table_schema, table_name) where o.checksum <> n.checksum"""
)
def changed_tables(spark, sf):
    return cat.changed_tables(_checksums(spark, sf, 1), _checksums(spark, sf, 2))


@query(
    f"""select o.table_schema, o.table_name, o.checksum as old_checksum, n.checksum as new_checksum
    from ({_checksum_sql(st.columns_v1_sql(), st.keys_sql(1))}) o join ({_checksum_sql(st.columns_v2_sql(), st.keys_sql(2))}) n
    using (table_schema, table_name) where o.checksum <> n.checksum"""
)
def changed_since_kept(spark, sf):
    """Checksums of two runs kept, the newest found again and compared with those of now."""
    path = workspace(spark, "catalog")
    old = _checksums(spark, sf, 1)
    sinks.write_catalog_version(_checksums(spark, sf, 2), path, "test", "sync", 9)
    sinks.write_catalog_version(old, path, "test", "sync", 10)
    kept = sinks.latest_catalog(spark, path, old.schema, "test", "sync").select(*old.columns)
    return cat.changed_tables(kept, _checksums(spark, sf, 2))


def _key_text_sql(version: int) -> str:
    return f"select table_schema, table_name, string_agg(column_name, ',' order by column_name) as k from ({st.keys_sql(version)}) group by all"


@query(
    f"""select table_schema, table_name, coalesce(o.k, '') as old_key, coalesce(n.k, '') as new_key,
    concat('~ Primary key changed: [', coalesce(o.k, ''), '] -> [', coalesce(n.k, ''), ']') as message
    from ({_key_text_sql(1)}) o full outer join ({_key_text_sql(2)}) n using (table_schema, table_name) where o.k is distinct from n.k"""
)
def key_change(spark, sf):
    return df_.key_change(*[_placed_keys(spark, sf, v) for v in (1, 2)])


DIFFERENT = """(b.o_custkey is distinct from f.o_custkey or b.o_orderstatus is distinct from f.o_orderstatus
  or b.o_totalprice is distinct from f.o_totalprice)"""


@query(
    f"""{_VERSIONS} select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey,
    case when b.o_orderkey is null then '+' when f.o_orderkey is null then '-' when {DIFFERENT} then '~' else '=' end as kind
    from base b full outer join final f on b.o_orderkey = f.o_orderkey"""
)
def snapshot_diff(spark, sf):
    return df_.snapshot_diff(*versions(spark, sf), KEY)


@query(
    f"""{_VERSIONS}, p as (select f.o_orderkey, b.o_orderstatus as os, f.o_orderstatus as ns, cast(b.o_totalprice as varchar) as op,
      cast(f.o_totalprice as varchar) as np from base b join final f on b.o_orderkey = f.o_orderkey where {DIFFERENT})
    select o_orderkey, 'o_orderstatus' as column_name, os as old_value, ns as new_value from p where os is distinct from ns
    union all select o_orderkey, 'o_totalprice', op, np from p where op is distinct from np"""
)
def column_level_diff(spark, sf):
    return df_.column_level_diff(*versions(spark, sf), KEY)


@query(f"{_VERSIONS} select {OUT} from final")
def diff_to_change_feed(spark, sf):
    """Round trip: the old version plus the feed made of the difference is the new version."""
    old, new = versions(spark, sf)
    return shown(ch.apply_changes(old, df_.diff_to_change_feed(old, new, KEY, seq=1), KEY))
