import hashlib

import pytest
from pyspark.sql import functions as F

from rowtide.functions.digests import additive_digest
from rowtide.operators import catalog as cat
from rowtide.operators import diff, lookup

COLS = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int, is_nullable string, character_maximum_length int, numeric_precision int, numeric_scale int"
OLD = [
    ("sales", "Customers", "CustomerId", "int", 1, "NO", None, None, None),
    ("sales", "Customers", "OldField", "varchar", 2, "YES", 20, None, None),
    ("sales", "Customers", "Status", "varchar", 3, "YES", 10, None, None),
    ("sales", "Customers", "Email", "varchar", 4, "NO", 50, None, None),
    ("sales", "Orders", "OrderId", "int", 1, "NO", None, None, None),
    ("sales", "Orders", "Total", "decimal", 2, "YES", None, 18, 2),
]
NEW = [
    ("sales", "Customers", "CustomerId", "int", 1, "NO", None, None, None),
    ("sales", "Customers", "Status", "int", 3, "YES", None, None, None),
    ("sales", "Customers", "Email", "varchar", 4, "YES", 80, None, None),
    ("sales", "Customers", "MiddleName", "varchar", 5, "YES", 50, None, None),
    ("sales", "Orders", "OrderId", "int", 1, "NO", None, None, None),
    ("sales", "Orders", "Total", "decimal", 2, "YES", None, 18, 2),
    ("sales", "Refunds", "RefundId", "int", 1, "NO", None, None, None),
]
KEYS = "table_schema string, table_name string, column_name string, key_position int"


def test_schema_diff_messages(spark):
    found = diff.schema_diff(spark.createDataFrame(OLD, COLS), spark.createDataFrame(NEW, COLS)).collect()
    assert {r.message for r in found if r.table_name == "Customers"} == {
        "+ Added column: MiddleName (varchar)",
        "- Removed column: OldField",
        "~ Modified column: Status (varchar -> int)",
        "~ Changed length: Status (10 -> none)",
        "~ Nullability changed: Email (NOT NULL -> NULL)",
        "~ Changed length: Email (50 -> 80)",
    }
    assert {r.table_name for r in found} == {"Customers", "Refunds"}
    summary = diff.change_summary(spark.createDataFrame(found)).collect()
    assert {(r.table_name, r.kind): r.n_changes for r in summary}[("Customers", "length")] == 2


def test_checksum_follows_columns_and_key_order(spark):
    old, new = spark.createDataFrame(OLD, COLS), spark.createDataFrame(NEW, COLS)
    one = spark.createDataFrame([("sales", "Orders", "OrderId", 1), ("sales", "Orders", "Total", 2)], KEYS)
    two = spark.createDataFrame([("sales", "Orders", "OrderId", 2), ("sales", "Orders", "Total", 1)], KEYS)
    same = cat.changed_tables(cat.schema_checksum(old, one), cat.schema_checksum(new.repartition(3), one))
    assert [r.table_name for r in same.collect()] == ["Customers"]
    swapped = cat.changed_tables(cat.schema_checksum(old, one), cat.schema_checksum(old, two))
    assert [r.table_name for r in swapped.collect()] == ["Orders"]
    change = diff.key_change(one, two).first()
    assert change.message == "~ Primary key changed: [OrderId,Total] -> [Total,OrderId]"


def test_new_tables(spark):
    old, new = (spark.createDataFrame(r, COLS).select(*cat.TABLE).distinct() for r in (OLD, NEW))
    assert [r.table_name for r in cat.new_entities(new, old, cat.TABLE).collect()] == ["Refunds"]


def test_primary_keys_do_not_mix_schemas(spark, rows):
    constraints = spark.createDataFrame(
        [("PK_T", "a", "T", "PRIMARY KEY"), ("PK_T", "b", "T", "PRIMARY KEY"), ("UQ", "a", "T", "UNIQUE")],
        "constraint_name string, table_schema string, table_name string, constraint_type string",
    )
    usage = spark.createDataFrame(
        [("PK_T", "a", "T", "x"), ("PK_T", "b", "T", "y"), ("UQ", "a", "T", "z")],
        "constraint_name string, table_schema string, table_name string, column_name string",
    )
    found = cat.primary_keys(constraints, usage)
    assert rows(found, "table_schema", "column_name") == [("a", "x"), ("b", "y")]


def test_key_positions_and_fallbacks(spark, rows):
    columns = spark.createDataFrame(
        [("s", "T", "a", 2), ("s", "T", "b", 1), ("s", "U", "p", 1), ("s", "U", "q", 2)],
        "table_schema string, table_name string, column_name string, ordinal_position int",
    )
    keys = spark.createDataFrame([("s", "T", "a"), ("s", "T", "b"), ("s", "T", "gone")], "table_schema string, table_name string, column_name string")
    placed = cat.key_by_position(keys, columns)
    assert rows(placed, "key_position", "column_name", "ordinal_position") == [(1, "b", 1), (2, "a", 2), (3, "gone", 999)]
    assert cat.first_key_column(keys, columns).first().chunk_column == "b"
    tables = spark.createDataFrame([("s", "T"), ("s", "U"), ("s", "V")], "table_schema string, table_name string")
    got = rows(cat.fallback_key(tables, keys, columns), "table_name", "column_name", "key_source")
    assert got[-2:] == [("U", "p", "first_column"), ("V", "id", "default")]
    assert len(got) == 5


def test_lookups(spark, rows):
    mapping = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("c", 1, "x")], "k string, priority int, v string")
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(lookup.lookup_first_match(df, mapping, ["k"]), "k", "v") == [("a", "first"), ("a", "first"), ("b", None)]
    default = spark.createDataFrame([("a", "d"), ("b", "d")], "k string, v string")
    custom = spark.createDataFrame([("a", "c"), ("z", "c")], "k string, v string")
    assert rows(lookup.union_with_priority(default, custom, ["k"])) == [("a", "c"), ("b", "d"), ("z", "c")]
    assert rows(lookup.union_with_priority(default, custom, ["k"], custom_wins=False)) == [("a", "d"), ("b", "d"), ("z", "c")]
    groups = spark.createDataFrame([("g1", ["a", "q"]), ("g2", [])], "g string, m array<string>")
    assert rows(lookup.array_membership(df.distinct(), groups, "k", "m"), "k", "g") == [("a", "g1"), ("b", None)]


def test_derived_columns_stay_rows(spark, rows):
    derived = spark.createDataFrame(
        [("s", "T", "a", "j1"), ("s", "T", "b", "j1"), ("s", "T", "a", "j2")],
        "table_schema string, table_name string, column_name string, job string",
    )
    assert rows(cat.derived_by_table(derived), "job", "job_columns", "table_columns", "table_jobs") == [("j1", 2, 3, 2), ("j2", 1, 3, 2)]


def test_discovery(spark, rows):
    names = ["Orders", "Orders_Archive", "tmp_x", "sysdiagrams", "MSlog"]
    tables = spark.createDataFrame([("s", n, "BASE TABLE") for n in names] + [("s", "V", "VIEW"), ("o", "Orders", "BASE TABLE")], "table_schema string, table_name string, table_type string")
    assert rows(cat.discover_tables(tables, "s", exclude=["tmp_*", "*_Archive"]), "table_name") == [("Orders",)]


@pytest.mark.parametrize("by", [cat.COLUMN, cat.TABLE])
def test_key_positions_of_repeated_and_null_names(spark, rows, by):
    names = "table_schema string, table_name string, column_name string"
    columns = [("s", "T", "a", 2), ("s", "T", "a", 2), ("s", "T", "a", 5), ("s", "T", "b", None), ("s", "T", None, 1), ("s", None, "a", 1), ("s", "U", "a", 1)]
    keys = [("s", "T", "a"), ("s", "T", "a"), ("s", "T", "b"), ("s", "T", "gone"), ("s", "T", None), ("s", "T", None), ("s", None, "a")]
    found = []
    for k in set(keys):
        met = [c[3] for c in columns if c[:3] == k and None not in k] or [None]
        found += [(*k, cat.UNKNOWN_POSITION if p is None else p) for p in met]
    expected = []
    for t in {f[:2] for f in found}:
        ordered = sorted((f for f in found if f[:2] == t), key=lambda f: (f[3], f[2] is not None, f[2] or ""))
        expected += [(*f, n) for n, f in enumerate(ordered, 1)]
    placed = cat.key_by_position(spark.createDataFrame(keys, names), spark.createDataFrame(columns, f"{names}, ordinal_position int"), by=by)
    assert placed.columns == [*cat.COLUMN, "ordinal_position", "key_position"]
    assert rows(placed) == sorted(expected, key=repr)


def test_checksum_is_the_same_however_rows_are_dealt_out(spark, rows):
    old, new = spark.createDataFrame(OLD, COLS), spark.createDataFrame(NEW, COLS)
    key = spark.createDataFrame([("sales", "Orders", "OrderId"), ("sales", "Orders", "Total"), ("sales", "Gone", "x")], "table_schema string, table_name string, column_name string")
    by_column, by_table = ([cat.schema_checksum(c, cat.key_by_position(key, old, by=by), by=by) for c in (old, new)] for by in (cat.COLUMN, cat.TABLE))
    assert [rows(f) for f in by_column] == [rows(f) for f in by_table]
    assert len(rows(by_table[0])) == 3


def test_digest_sums_are_exact(spark):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)] + ["f" * 64] * 50 + ["0" * 64]
    totals = [sum(int(d[k : k + 16], 16) for d in digests) for k in range(0, 64, 16)]
    found = spark.createDataFrame([(d,) for d in digests], "d string").repartition(5).agg(additive_digest(F.col("d")).alias("x"))
    assert found.first().x == "-".join(map(str, [len(digests), *totals]))
