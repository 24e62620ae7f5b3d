"""Row numbers over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowtide.session import pinned, shuffle_width

RANGE = "_rk_range"
#: Sampled rows per range that bounds are chosen from.
_SAMPLE = 40
#: Characters of a text that a bound keeps. Any bound serves, so long texts neither pass through the driver nor stand in a plan.
_BOUND_CHARS = 256


class Desc(NamedTuple):
    """A column to order by from the greatest down, nulls last."""

    column: str


#: A column name orders from the least up, nulls first.
Order = str | Desc


def _name(item: Order) -> str:
    return item.column if isinstance(item, Desc) else item


def sort_columns(order: Sequence[Order]) -> list[Column]:
    return [F.desc_nulls_last(o.column) if isinstance(o, Desc) else F.asc_nulls_first(o) for o in order]


def _at_or_after(order: Sequence[Order], bound: Column) -> Column:
    """Whether a row is at a bound (a struct c0, c1, …) or behind it in the order."""
    found = F.lit(True)
    for i, o in reversed(list(enumerate(order))):
        ours, theirs = F.col(_name(o)), bound.getField(f"c{i}")
        if isinstance(o, Desc):
            behind = (ours.isNull() & theirs.isNotNull()) | (ours < theirs)
        else:
            behind = (ours.isNotNull() & theirs.isNull()) | (ours > theirs)
        found = F.coalesce(behind, F.lit(False)) | (ours.eqNullSafe(theirs) & found)
    return found


class Ranges:
    """Rows cut into ranges of about equal size by group and order, so that a group of any size spreads over many.

    Only the group and order columns are kept (checkpointed) and sampled for the bounds; the rows themselves are not stored.
    ``df`` is read again for the result and must give the same rows then. ``number`` is the range of a row; equal rows share one.
    """

    def __init__(self, df: DataFrame, group: Sequence[str], order: Sequence[Order], partitions: int | None = None, distinct: bool = False):
        self.group = list(group)
        self.by = [*self.group, *order]
        width = partitions or shuffle_width(df.sparkSession)
        keys = df.select(*dict.fromkeys(map(_name, self.by)))
        keys = pinned(keys.distinct() if distinct else keys)
        self.number = self._number(self._bounds(keys, width))
        self.keys = keys.withColumn(RANGE, self.number)

    def _bounds(self, keys: DataFrame, width: int) -> list[tuple]:
        """At most ``width - 1`` rows of the sample at even distances; the sample has about ``_SAMPLE`` rows a range."""
        n, wanted = keys.count(), _SAMPLE * width
        if width < 2 or n < 2:
            return []
        kinds = {f.name: f.dataType for f in keys.schema}
        short = [F.substring(c, 1, _BOUND_CHARS).alias(c) if kinds[c] == StringType() else F.col(c) for c in keys.columns]
        sample = keys.sample(min(1.0, 1.5 * wanted / n), 17).select(*short).limit(3 * wanted)
        rows = [tuple(r[_name(o)] for o in self.by) for r in sample.sort(*sort_columns(self.by)).collect()]
        chosen = [rows[k * len(rows) // width] for k in range(1, width)] if rows else []
        self._kinds = [keys.schema[_name(o)].dataType for o in self.by]
        return [b for k, b in enumerate(chosen) if k == 0 or b != chosen[k - 1]]

    def _number(self, bounds: list[tuple]) -> Column:
        """Binary search for a row among the bounds."""
        if not bounds:
            return F.lit(0)
        literal = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(b, self._kinds))]) for b in bounds])

        def halve(found: Column, _: Column) -> Column:
            lo, hi = found["lo"], found["hi"]
            mid = F.shiftright(lo + hi, 1)
            # the bound by a lambda: the array of all of them stands in the plan once, not at each comparison
            behind = F.exists(F.array(F.get(literal, mid)), lambda bound: _at_or_after(self.by, bound))
            narrowed = F.when(behind, F.struct((mid + 1).alias("lo"), hi.alias("hi"))).otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))
            return F.when(lo < hi, narrowed).otherwise(found)

        start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
        steps = F.array(*[F.lit(0)] * len(bounds).bit_length())
        return F.aggregate(steps, start, halve, lambda found: found["lo"])

    def shared_groups(self) -> DataFrame | None:
        """Groups that may lie in several ranges: those first and last in a range, so at most two per range. None without groups."""
        if not self.group:
            return None
        ends = self.keys.groupBy(RANGE).agg(*[f(F.struct(*self.group)).alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))])
        return ends.select(F.explode(F.array("_first", "_last")).alias("_g")).select("_g.*").distinct()

    def of_shared_groups(self, rows: DataFrame) -> DataFrame:
        """The rows (with their range) of groups that may lie in several ranges."""
        groups = self.shared_groups()
        if groups is None:
            return rows
        return rows.join(F.broadcast(groups), same_values(rows, groups, self.group), "left_semi")

    def with_shared(self, rows: DataFrame, heads: DataFrame) -> DataFrame:
        """Rows with the columns that ``heads`` (range, group, …) has for their range and group, null where it has none.

        ``heads`` has at most a few rows per range, so it is broadcast.
        """
        named = heads.withColumnsRenamed({c: f"_head_{c}" for c in (RANGE, *self.group)})
        on = rows[RANGE] == named[f"_head_{RANGE}"]
        for g in self.group:
            on = on & rows[g].eqNullSafe(named[f"_head_{g}"])
        return rows.join(F.broadcast(named), on, "left").drop(*[f"_head_{c}" for c in (RANGE, *self.group)])


def same_values(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Order],
    rank: str = "rank_no",
    size: str | None = None,
    dense: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows of each group by ``order`` (make it total); ``size`` adds the group's rows.

    A plain window would sort a whole group in one task. Here rows are numbered within ranges of group and order, with one
    shuffle, and a range goes on from the rows its group has in earlier ranges. Only groups at a range's ends can cross
    a bound, so those counts are a few per range. With ``dense`` equal rows share a number and none is left out.
    """
    ranges = Ranges(df, group, order, partitions, distinct=dense)
    heads = ranges.of_shared_groups(ranges.keys).groupBy(RANGE, *group).agg(F.count("*").alias("_rk_n"))
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    heads = pinned(heads.select(RANGE, *group, F.sum("_rk_n").over(earlier).alias("_rk_before"), F.sum("_rk_n").over(of_group).alias("_rk_size")))
    inside = Window.partitionBy(RANGE, *group)
    number = F.dense_rank() if dense else F.row_number()
    rows = df.withColumn(RANGE, ranges.number)
    rows = rows.withColumn("_rk_place", number.over(inside.orderBy(*sort_columns(order))).cast("long"))
    if size:
        rows = rows.withColumn("_rk_inside", F.count("*").over(inside))
    rows = ranges.with_shared(rows, heads)
    added = {rank: F.col("_rk_place") + F.coalesce("_rk_before", F.lit(0))}
    if size:
        added[size] = F.coalesce("_rk_size", "_rk_inside")
    return rows.select(*df.columns, *[v.alias(k) for k, v in added.items()])


def chunk_groups(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Order],
    max_size: int,
    name: str = "group_no",
) -> DataFrame:
    """Cut each ordered group into runs of at most ``max_size`` rows, numbered from 1."""
    numbered = ranked(df, group, order, rank="_rn")
    return numbered.withColumn(name, _run_no(F.col("_rn"), max_size)).drop("_rn")


def _run_no(number: Column, max_size: int) -> Column:
    return F.call_function("div", number - 1, F.lit(max_size)) + 1
