"""Row and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import MATCHERS, is_system_name, name_selected, selected

DERIVED = "derived"


def select_names(
    df: DataFrame,
    column: str,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> DataFrame:
    """Rows whose name passes the include and exclude patterns; exclusion wins."""
    return df.where(selected(F.col(column), include, exclude, mode))


def without_system_names(df: DataFrame, column: str, case_sensitive: bool = True) -> DataFrame:
    return df.where(~is_system_name(F.col(column), case_sensitive))


def where_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows equal to every bound value; such filters reach the scan."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def in_list(df: DataFrame, column: str, names: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose value is listed; an empty list keeps nothing. A frame joins as a semi join."""
    if isinstance(names, DataFrame):
        listed = names.select(F.col(names.columns[0]).alias(column))
        return df.join(listed, column, "left_semi")
    return df.where(F.col(column).isin(list(names))) if names else df.where(F.lit(False))


def exclude_list(
    df: DataFrame,
    column: str,
    names: Sequence[str] | DataFrame,
    mode: str = "exact",
) -> DataFrame:
    """Rows whose name is not listed, whatever the case. ``mode='glob'`` reads names as globs."""
    if isinstance(names, DataFrame):
        listed = names.select(F.lower(names.columns[0]).alias("_listed")).distinct()
        return df.join(listed, F.lower(df[column]) == listed["_listed"], "left_anti")
    if not names:
        return df
    if mode == "exact":
        hit = F.lower(F.col(column)).isin([n.lower() for n in names])
    else:
        hit = MATCHERS[mode](F.col(column), names)
    return df.where(~F.coalesce(hit, F.lit(False)))


def in_tier(df: DataFrame, tier: str, column: str = "category") -> DataFrame:
    return df.where(F.col(column) == tier)


def default_fill(df: DataFrame, columns: Sequence[str], value: object = 0) -> DataFrame:
    """Missing counters become a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def kept_columns(
    df: DataFrame,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> list[str]:
    """Names of ``df`` that pass the patterns, by the same rule as row names."""
    return [c for c in df.columns if name_selected(c, include, exclude, mode)]


def project_columns(
    df: DataFrame,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> DataFrame:
    """Keep the columns whose names pass the patterns."""
    return df.select(*kept_columns(df, include, exclude, mode))


def project_override(
    df: DataFrame,
    exclude_columns: Sequence[str] = (),
    include_columns: Sequence[str] = (),
) -> DataFrame:
    """Per-table choice by exact name: first drop, then keep only what is listed, if anything is."""
    left = [c for c in df.columns if c not in set(exclude_columns)]
    if include_columns:
        left = [c for c in left if c in set(include_columns)]
    return df.select(*left)


def mark_derived(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Flag columns as derived in their metadata."""
    for c in columns:
        df = df.withMetadata(c, {DERIVED: True})
    return df


def drop_derived(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Leave out derived columns, named here or flagged by :func:`mark_derived`."""
    flagged = {f.name for f in df.schema.fields if f.metadata.get(DERIVED)}
    return df.drop(*(flagged | set(columns)))


def explicit_select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in the given order, so that both sides of a copy agree."""
    return df.select(*columns)


def key_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns first, the others after, each in source order."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not selected: {missing}")
    head = [c for c in df.columns if c in set(keys)]
    return df.select(*head, *[c for c in df.columns if c not in set(keys)])


def sensitive_projection(
    df: DataFrame,
    denied: Sequence[str],
    allowed: Sequence[str] = (),
    mode: str = "glob",
) -> DataFrame:
    """A copy without sensitive columns: denied patterns go first, then an allow-list applies.

    An allowed name that a denied pattern matches is an error in the request, so it raises.
    """
    safe = project_columns(df, exclude=denied, mode=mode)
    refused = [c for c in allowed if c in df.columns and c not in safe.columns]
    if refused:
        raise ValueError(f"allow-list names denied columns: {refused}")
    return project_override(safe, include_columns=allowed)
