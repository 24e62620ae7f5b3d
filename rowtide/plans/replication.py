"""A replication job: selection, conversion and apply of several tables put together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.conversions import ColumnSpec
from rowtide.functions.text import name_selected
from rowtide.operators.changes import OP, SEQ
from rowtide.operators.quality import conform
from rowtide.operators.selection import drop_derived, key_first, kept_columns, project_override
from rowtide.sources.table_set import TableSet, TableSpec, tagged, tagged_union


@dataclass(frozen=True)
class TableRule:
    """What is particular to one table: its key, its columns and their declared types."""

    keys: Sequence[str]
    exclude_columns: Sequence[str] = ()
    include_columns: Sequence[str] = ()
    derived: Sequence[str] = ()
    specs: Sequence[ColumnSpec] = ()


@dataclass(frozen=True)
class JobRule:
    """Patterns that hold for all tables of a job, and a rule for each table."""

    tables: Mapping[str, TableRule]
    include_tables: Sequence[str] = ()
    exclude_tables: Sequence[str] = ()
    include_columns: Sequence[str] = ()
    exclude_columns: Sequence[str] = ()
    mode: str = "glob"
    envelope: Sequence[str] = (OP, SEQ)

    def chosen(self, names: Sequence[str]) -> list[str]:
        """Tables of the job among the given ones; each needs a rule, as it needs a key."""
        picked = [n for n in names if name_selected(n, self.include_tables, self.exclude_tables, self.mode)]
        missing = [n for n in picked if n not in self.tables]
        if missing:
            raise ValueError(f"tables without a rule: {missing}")
        return picked


def jobs_from_plan(plan: DataFrame, entity: str, base: JobRule) -> dict[str, JobRule]:
    """A rule per job of a plan (entity, job_name), each with the base rule's settings and its own tables.

    Only tables that ``base`` has a rule for are taken, so at most those come to the driver.
    """
    known = plan.where(F.col(entity).isin(list(base.tables))).select(entity, "job_name").distinct().collect()
    members: dict[str, list[str]] = {}
    for table, job in known:
        members.setdefault(job, []).append(table)
    return {job: replace(base, tables={t: base.tables[t] for t in sorted(names)}, include_tables=sorted(names)) for job, names in members.items()}


def prepared(df: DataFrame, job: JobRule, table: str) -> DataFrame:
    """Rows of a table as the job replicates them, snapshot or change feed alike.

    Derived columns go first, then the job's column patterns and the table's own lists apply; what is
    left is converted and put in key-first order. A key column that was not selected is an error.
    """
    rule = job.tables[table]
    envelope = [c for c in job.envelope if c in df.columns]
    rows = drop_derived(df.drop(*envelope), rule.derived)
    rows = rows.select(*kept_columns(rows, job.include_columns, job.exclude_columns, job.mode))
    names = key_first(project_override(rows, rule.exclude_columns, rule.include_columns), rule.keys).columns
    declared = [s for s in rule.specs if s.name in names]
    return conform(df.select(*names, *envelope), declared)


def load_job(
    spark: SparkSession, root: str, job: JobRule, snapshots: Mapping[str, DataFrame], buckets: int = 16
) -> TableSet:
    """The job's tables, filled from their snapshots."""
    ready = {n: prepared(snapshots[n], job, n) for n in job.chosen(list(snapshots))}
    specs = {n: TableSpec(job.tables[n].keys, df.schema) for n, df in ready.items()}
    target = TableSet(spark, root, specs, buckets)
    target.load(ready)
    return target


def job_feed(job: JobRule, changes: Mapping[str, DataFrame]) -> DataFrame:
    """One tagged feed of all the job's tables, for ``TableSet.apply`` or a stream into it."""
    parts = []
    for name in job.chosen(list(changes)):
        rows = prepared(changes[name], job, name)
        parts.append(tagged(rows, name, [c for c in rows.columns if c not in job.envelope]))
    return tagged_union(parts)
