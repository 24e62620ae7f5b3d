"""What the operators share: stored intermediate tables, row numbers, ASCII lower-casing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import shuffle_width, workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Cuts the lineage: later steps and retries after a lost executor read the same rows.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched (``lower`` would fold letters of other alphabets too)."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; inside a lambda an expression would be computed for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def numbered(df: DataFrame, order: Sequence[str], group: str | None = None, name: str = "row_no") -> DataFrame:
    """``df`` with a gapless number from 0 per ``group`` in ``order`` (nulls first), stored.

    Rows are dealt by ranges of group and order, so a group of any size spreads over the tasks;
    only one count per task and group is gathered. ``group`` must have few values, as these counts
    are broadcast. Rows equal in all of ``order`` are numbered in any order.
    """
    keys = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + list(order)]
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", 33))
    of = group or "_all"
    if group is None:
        placed = placed.withColumn("_all", F.lit(0))
    heads = placed.groupBy("_part", of).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(of).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    heads = heads.select(F.col("_part").alias("_hp"), F.col(of).alias("_hg"), "_base")
    # one row per task and group: bounded by the number of tasks times the few groups
    on = (F.col("_part") == F.col("_hp")) & F.col(of).eqNullSafe(F.col("_hg"))
    out = placed.join(F.broadcast(heads), on).withColumn(name, F.col("_at") + F.col("_base"))
    return out.select(*df.columns, name)
