from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide.functions.conversions import ColumnSpec, converted
from rowtide.functions.typemap import TYPE_MAP, type_map_frame
from rowtide.operators import catalog as cat
from rowtide.operators import quality

TS = datetime(2024, 1, 2, 3, 4, 5, 678912)


def convert(spark, value, kind, source_type, **options):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(converted(F.col("v"), ColumnSpec("v", source_type, **options)).alias("v")).first().v


@pytest.mark.parametrize(
    "value, kind, source_type, options, expected",
    [
        ("255", "string", "tinyint", {}, 255),
        ("256", "string", "tinyint", {}, None),
        ("-1", "string", "tinyint", {}, None),
        ("12x", "string", "int", {}, None),
        ("99999999999", "string", "int", {}, None),
        ("1.23456", "string", "money", {}, Decimal("1.2346")),
        (123456.0, "double", "decimal", {"precision": 6, "scale": 2}, None),
        ("7", "string", "numeric", {}, Decimal("7")),
        ("ab", "string", "char", {"length": 4}, "ab  "),
        ("abcdef", "string", "char", {"length": 4}, "abcdef"),
        ("abcdef", "string", "char", {"length": 4, "truncate": True}, "abcd"),
        ("abcdef", "string", "varchar", {"length": 4, "truncate": True}, "abcd"),
        ("abcdef", "string", "varchar", {"length": -1, "truncate": True}, "abcdef"),
        ("2024-01-02", "string", "date", {}, date(2024, 1, 2)),
        (TS, "timestamp_ntz", "datetime", {}, datetime(2024, 1, 2, 3, 4, 5, 678000)),
        (TS, "timestamp_ntz", "datetime2", {}, TS),
        (TS, "timestamp_ntz", "datetime2", {"scale": 1}, datetime(2024, 1, 2, 3, 4, 5, 600000)),
        (TS, "timestamp_ntz", "smalldatetime", {}, datetime(2024, 1, 2, 3, 4, 5)),
        (TS, "timestamp_ntz", "time", {"scale": 3}, "03:04:05.678"),
        ("03:04:05.5", "string", "time", {"scale": 2}, "03:04:05.50"),
        ("03:04:05.5", "string", "time", {"scale": 0}, "03:04:05"),
        ("1", "string", "bit", {}, True),
        (bytearray(b"\x0a\xff"), "binary", "varbinary", {"length": 2}, "0AFF"),
        ("<g/>", "string", "geography", {}, "<g/>"),
    ],
)
def test_conversions(spark, value, kind, source_type, options, expected):
    assert convert(spark, value, kind, source_type, **options) == expected


def test_offsets_become_instants(spark):
    out = spark.sql("select '2024-01-02 03:04:05.678+02:00' as v").select(
        converted(F.col("v"), ColumnSpec("v", "datetimeoffset", scale=0)).cast("string").alias("v")
    )
    assert out.first().v == "2024-01-02 01:04:05"


def test_report_and_quarantine(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "abc", "6F9619FF-8B86-D011-B42D-00C04FC964FF", "1", '{"a":1}'),
            (None, "abcd", "not-a-guid", "x", "{bad"),
            (3, None, None, None, None),
        ],
        "id int, name string, guid string, n string, doc string",
    )
    specs = [
        ColumnSpec("id", "int", nullable=False),
        ColumnSpec("name", "varchar", length=3),
        ColumnSpec("guid", "uniqueidentifier"),
        ColumnSpec("n", "int"),
        ColumnSpec("doc", "json"),
    ]
    report = {r.column_name: r for r in quality.conformance_report(df, specs).collect()}
    assert (report["id"].n_rows, report["id"].n_nulls, report["id"].null_in_not_null) == (3, 1, 1)
    assert (report["name"].over_length, report["name"].n_nulls, report["name"].null_in_not_null) == (1, 1, 0)
    assert [report[c].failed_cast for c in ("id", "name", "guid", "n", "doc")] == [0, 0, 1, 1, 1]
    valid, rejected = quality.quarantine(df, specs)
    assert rows(valid, "id", "n") == [(1, 1), (3, None)]
    assert rejected.select("reasons").first().reasons == [
        "id:null_in_not_null",
        "name:over_length",
        "guid:failed_cast",
        "n:failed_cast",
        "doc:failed_cast",
    ]


def test_key_quality(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, None), (3, 1)], "a int, b int")
    row = quality.key_quality(df, ["a", "b"]).first()
    assert tuple(row) == (5, 2, 1, 1, 2, False)
    assert quality.key_quality(df.select("a").distinct(), ["a"]).first().is_unique
    assert quality.key_quality(df.limit(0), ["a"]).first().n_rows == 0


def columns(spark, *rows):
    schema = (
        "table_schema string, table_name string, column_name string, data_type string, "
        "character_maximum_length int, numeric_precision int, numeric_scale int"
    )
    return spark.createDataFrame([("s", "t", *r) for r in rows], schema)


def test_type_map(spark):
    assert len(TYPE_MAP) == 29
    df = columns(
        spark,
        ("a", "VARCHAR", 50, None, None),
        ("b", "nvarchar", -1, None, None),
        ("c", "varchar", None, None, None),
        ("d", "decimal", None, 18, 2),
        ("e", "decimal", None, None, None),
        ("f", "varbinary", 16, None, None),
        ("g", "varbinary", None, None, None),
        ("h", "geography", None, None, None),
        ("i", "datetime2", None, None, 3),
        ("j", "int", None, None, None),
    )
    got = {r.column_name: (r.stream_type, r.target_type, r.is_mapped) for r in cat.map_types(df).collect()}
    assert got == {
        "a": ("VARCHAR(50)", "VARCHAR(50)", True),
        "b": ("VARCHAR(65535)", "VARCHAR(65535)", True),
        "c": ("VARCHAR(255)", "VARCHAR(255)", True),
        "d": ("DECIMAL(18,2)", "DECIMAL(18,2)", True),
        "e": ("DECIMAL(10,0)", "DECIMAL(10,0)", True),
        "f": ("VARCHAR(32)", "VARBINARY", True),
        "g": ("VARCHAR(254)", "VARBINARY", True),
        "h": ("STRING", "STRING", False),
        "i": ("TIMESTAMP(3)", "DATETIME", True),
        "j": ("INT", "INT", True),
    }
    custom = spark.createDataFrame([("s", "t", "j", "BIGINT")], "table_schema string, table_name string, column_name string, custom_type string")
    first = cat.map_types(df, per_column=custom).where("column_name = 'j'").first()
    assert (first.stream_type, first.target_type) == ("BIGINT", "BIGINT")


def test_custom_mapping_precedence(spark):
    custom = [("int", "BIGINT", "BIGINT"), ("geography", "GEO", "GEO")]
    wins = {r.source_type: r.stream_type for r in type_map_frame(spark, custom).collect()}
    loses = {r.source_type: r.stream_type for r in type_map_frame(spark, custom, custom_wins=False).collect()}
    assert (wins["int"], wins["geography"]) == ("BIGINT", "GEO")
    assert (loses["int"], loses["geography"]) == ("INT", "GEO")
    assert len(wins) == len(loses) == 30


def test_unregister_restores_the_built_in(spark):
    from rowtide.functions import conversions as cv

    spec = cv.ColumnSpec("v", "varchar", length=2)
    df = spark.createDataFrame([("abc",)], "v string")
    before = df.select(cv.converted(F.col("v"), spec)).first()[0]
    cv.register_conversion("varchar", lambda c, _: F.lit("mine"))
    assert df.select(cv.converted(F.col("v"), spec)).first()[0] == "mine"
    cv.unregister_conversion("varchar")
    assert cv.is_mapped("varchar") and df.select(cv.converted(F.col("v"), spec)).first()[0] == before
