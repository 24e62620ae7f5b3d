"""Compare a Spark result with DuckDB's answer on the same files."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in names, types or rows; empty when both agree."""
    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    problems = []
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return [f"columns {names} vs {sorted(theirs.column_names)}"]
    for n in names:
        a, b = str(ours.schema.field(n).type), str(theirs.schema.field(n).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            problems.append(f"type of {n}: {a} vs {b}")
    rows = [Counter(zip(*[t.column(n).to_pylist() for n in names])) for t in (ours, theirs)]
    if rows[0] != rows[1]:
        extra, missing = rows[0] - rows[1], rows[1] - rows[0]
        problems.append(
            f"rows {ours.num_rows} vs {theirs.num_rows}; only ours {list(extra)[:3]}; only theirs {list(missing)[:3]}"
        )
    return problems
