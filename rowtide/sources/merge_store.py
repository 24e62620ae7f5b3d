"""Keyed tables on plain Parquet, merged on read.

Layout under one root folder::

    base/version=V/<parts>/             state rows, rewritten per part by compaction
    delta/<epoch>-<batch>-<no>-<try>/   latest change per key of one attempt at a batch, by part
    commit/<epoch>-<batch>-<no>-<try>   written after that delta; a delta without it is not read
    manifest/version=V/                 epoch, schema, base version of every part, deltas folded in and not yet deleted

A part is a bucket of the key (and, in a table set, the table). Every attempt at a batch has a folder of its
own, so a replay touches nothing that is being read; applying a batch twice changes nothing, as the
later change of a key wins whatever the order. Commits are numbered as they come. A compaction lists the very deltas it folded
in, so batch numbers may start over with a new checkpoint. It folds small deltas into one another, and into the base
once they come to a share of it, so a batch costs about its own size and not that of the table. Loading a
snapshot starts an epoch: deltas of earlier ones are not read any more. Everything is written by Spark's own committers and
read back by explicit paths; :meth:`MergeStore.vacuum` removes what no reader needs any more. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from rowtide.operators.changes import DELETE, OP, SEQ, as_state, change_order, latest_change_per_key, live_rows, same_keys
from rowtide.session import child_folders, delete_folder, folder_bytes, input_tasks, make_mark, shuffle_width

BUCKET = "bucket"
TABLE_NAME = "table_name"

#: A compaction rewrites the base once the open deltas come to this share of the parts they touch.
BASE_SHARE = 0.25


class Delta(NamedTuple):
    """A committed delta; its folder and its mark have the same name."""

    epoch: int
    batch_id: int
    #: number of the commit, from 0 in its epoch; of several folded into one the last
    number: int
    attempt: str

    @property
    def name(self) -> str:
        return f"{self.epoch}-{self.batch_id}-{self.number}-{self.attempt}"


class Manifest(NamedTuple):
    version: int
    epoch: int
    #: names of deltas folded in whose folders still exist
    folded: frozenset[str]
    #: base version of every part
    parts: dict[tuple, int]
    #: number of the last commit that went into the base, and of the last one listed in ``folded``; -1 for none
    base_number: int
    last_number: int
    #: the state rows' schema without the parts, as JSON
    schema: str | None


#: Begins the attempt of a delta that stands for several.
_RUN = "run"
#: Types files written before may be read through, as Spark's Parquet reader widens them.
_WIDER = {
    ByteType: (ShortType, IntegerType, LongType),
    ShortType: (IntegerType, LongType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}


def not_widened(old: StructType, new: StructType, identity: Sequence[str]) -> list[str]:
    """What keeps ``new`` from being ``old`` with columns added or types widened; keys keep their type."""
    fields = {f.name: f.dataType for f in new.fields}
    found = []
    for f in old.fields:
        kind = fields.get(f.name)
        if kind is None:
            found.append(f"{f.name} is missing")
        elif kind != f.dataType and (f.name in identity or not _is_wider(f.dataType, kind)):
            found.append(f"{f.name}: {f.dataType.simpleString()} to {kind.simpleString()}")
    return found


def _is_wider(old: DataType, new: DataType) -> bool:
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(new, _WIDER.get(type(old), ()))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class MergeStore:
    """State of rows identified by ``identity``, kept in ``parts`` that are rewritten separately.

    ``schema`` is that of a state row without the parts: identity, payload, ``op`` and ``seq``.
    """

    def __init__(
        self, spark: SparkSession, root: str, identity: Sequence[str], schema: StructType, parts: StructType
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.identity = list(identity)
        self.parts = parts
        self.part_names = parts.names
        self.schema = StructType([*schema.fields, *parts.fields])

    # -- small metadata ----------------------------------------------------------------------

    def _manifest_schema(self) -> StructType:
        header = "base_version long, epoch long, folded array<string>, base_number long, last_number long, row_schema string"
        return StructType([*self.parts.fields, *StructType.fromDDL(header).fields])

    def _versions(self) -> list[int]:
        """Finished manifest versions, ascending."""
        names = [n for n in child_folders(self.spark, f"{self.root}/manifest") if n.startswith("version=")]
        versions = sorted(int(n.removeprefix("version=")) for n in names)
        return [v for v in versions if "_SUCCESS" in child_folders(self.spark, f"{self.root}/manifest/version={v}")]

    def _manifest(self, version: int | None = None) -> Manifest:
        """One manifest, the newest unless named; only its folder is read."""
        if version is None:
            version = next(iter(self._versions()[::-1]), -1)
        if version < 0:
            return Manifest(-1, 0, frozenset(), {}, -1, -1, None)
        rows = self.spark.read.schema(self._manifest_schema()).json(f"{self.root}/manifest/version={version}").collect()
        head = next(r for r in rows if r.base_version is None)
        parts = {tuple(r[p] for p in self.part_names): r.base_version for r in rows if r.base_version is not None}
        return Manifest(version, head.epoch, frozenset(head.folded or ()), parts, head.base_number, head.last_number, head.row_schema)

    def _write_manifest(self, new: Manifest) -> None:
        rows = [(*part, v, new.epoch, None, None, None, None) for part, v in new.parts.items()]
        head = (None, new.epoch, sorted(new.folded), new.base_number, new.last_number, self._row_schema().json())
        rows.append((*[None] * len(self.part_names), *head))
        frame = self.spark.createDataFrame(rows, self._manifest_schema()).coalesce(1)
        frame.write.mode("overwrite").json(f"{self.root}/manifest/version={new.version}")

    def _row_schema(self) -> StructType:
        return StructType([f for f in self.schema.fields if f.name not in self.part_names])

    def stored_schema(self) -> StructType | None:
        """Schema of the state rows as last written to the manifest; None before the first."""
        text = self._manifest().schema
        return None if text is None else StructType.fromJson(json.loads(text))

    def change_schema(self, schema: StructType) -> None:
        """From now on rows have ``schema``: columns may be added and types widened; files written before are read through it."""
        refused = not_widened(self.stored_schema() or self._row_schema(), schema, self.identity)
        if refused:
            raise ValueError(f"a keyed table only takes new columns and wider types: {refused}")
        self.schema = StructType([*schema.fields, *self.parts.fields])
        now = self._manifest()
        self._write_manifest(now._replace(version=now.version + 1))

    def _check_schema(self, now: Manifest) -> None:
        if now.schema is None:
            return
        refused = not_widened(StructType.fromJson(json.loads(now.schema)), self._row_schema(), self.identity)
        if refused:
            raise ValueError(f"the table was written with another schema, open it with that: {refused}")

    def _marks(self) -> list[Delta]:
        """All commit marks, by a listing of their names."""
        found = (n.split("-", 3) for n in child_folders(self.spark, f"{self.root}/commit"))
        return sorted(Delta(int(e), int(k), int(no), a) for e, k, no, a in found)

    def open_deltas(self, now: Manifest | None = None, upto: int | None = None) -> list[Delta]:
        """Committed deltas of the current epoch that no compaction has folded in, in the order of their commits.

        ``upto`` leaves out those after commit number ``upto`` of the epoch; once such a commit has been folded in, the earlier
        state is gone and asking for it is an error.
        """
        now = now or self._manifest()
        found = sorted((d for d in self._marks() if d.epoch == now.epoch and d.name not in now.folded), key=lambda d: (d.number, d.name))
        if upto is None:
            return found
        if now.base_number > upto or any(d.number > upto for d in self._folded_runs(now)):
            raise ValueError(f"commit {upto} has been folded together with later ones")
        return [d for d in found if d.number <= upto]

    def _folded_runs(self, now: Manifest) -> list[Delta]:
        """Open deltas that stand for several commits."""
        return [d for d in self._marks() if d.epoch == now.epoch and d.name not in now.folded and d.attempt.startswith(_RUN)]

    def committed_batches(self) -> list[int]:
        """Batches of the current epoch whose deltas still exist."""
        epoch = self._manifest().epoch
        return sorted({d.batch_id for d in self._marks() if d.epoch == epoch})

    # -- writing ------------------------------------------------------------------------------

    def _write_parts(self, df: DataFrame, path: str) -> None:
        """Few files per part: rows are brought together by part, and large parts are split again.

        A task sorts its rows by part before it writes them. So that its share does not grow with the input, a large one is dealt out by part
        and slice of a part, over as many tasks as the files it is read from ask for.
        """
        tasks = input_tasks(df)
        placed = df.hint("rebalance", *self.part_names)
        if tasks > 1:
            slice_no = F.pmod(F.hash(*self.identity), F.lit(tasks))
            placed = df.repartitionById(tasks, F.pmod(F.xxhash64(*self.part_names) + slice_no, F.lit(tasks)).cast("int"))
        placed.write.mode("overwrite").partitionBy(*self.part_names).parquet(path)

    def put_base(self, state: DataFrame) -> None:
        """Start from a snapshot: one row per identity. Changes applied before belong to an earlier epoch and no longer count."""
        now = self._manifest()
        version = now.version + 1
        path = f"{self.root}/base/version={version}"
        self._write_parts(state.select(*self.schema.names), path)
        self._write_manifest(Manifest(version, now.epoch + 1, frozenset(), self._parts_in(path, version), -1, -1, None))

    def _parts_in(self, path: str, version: int) -> dict[tuple, int]:
        """Parts a base folder holds; their number is bounded by buckets times tables."""
        rows = self.spark.read.schema(self.schema).parquet(path).select(*self.part_names).distinct().collect()
        return {tuple(r): version for r in rows}

    def put_delta(self, changes: DataFrame, batch_id: int) -> None:
        """Write the latest change per identity of a batch into a new folder, then its commit mark."""
        now = self._manifest()
        self._check_schema(now)
        number = 1 + max([now.last_number, *[d.number for d in self._marks() if d.epoch == now.epoch]])
        latest = latest_change_per_key(changes.select(*self.schema.names), [*self.identity, *self.part_names])
        self._commit(latest, Delta(now.epoch, batch_id, number, uuid.uuid4().hex))

    def _commit(self, latest: DataFrame, delta: Delta) -> None:
        self._write_parts(latest, f"{self.root}/delta/{delta.name}")
        make_mark(self.spark, f"{self.root}/commit/{delta.name}")

    # -- reading ------------------------------------------------------------------------------

    def _base_folder(self, part: tuple, version: int) -> str:
        names = [f"{n}={x}" for n, x in zip(self.part_names, part)]
        return "/".join([f"{self.root}/base/version={version}", *names])

    def _base(self, parts: dict[tuple, int], where: Column | None) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        folders = [self._base_folder(part, v) for part, v in parts.items()]
        df = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/base").parquet(*folders)
        df = df.select(*self.schema.names)
        return df if where is None else df.where(where)

    def _deltas(self, deltas: Sequence[Delta], where: Column | None) -> DataFrame:
        out = None
        for d in deltas:
            folder = f"{self.root}/delta/{d.name}"
            one = self.spark.read.schema(self.schema).option("basePath", folder).parquet(folder).select(*self.schema.names)
            out = one if out is None else out.unionByName(one)
        return out if where is None else out.where(where)

    def _touched(self, deltas: Sequence[Delta]) -> set[tuple]:
        """Parts that deltas have rows of, by a listing of their folders."""
        found = set()
        for d in deltas:
            paths = [((), f"{self.root}/delta/{d.name}")]
            for field in self.parts.fields:
                below = []
                for part, path in paths:
                    for name in child_folders(self.spark, path):
                        if name.startswith(f"{field.name}="):
                            text = unquote(name.removeprefix(f"{field.name}="))
                            below.append(((*part, int(text) if isinstance(field.dataType, IntegerType) else text), f"{path}/{name}"))
                paths = below
            found |= {part for part, _ in paths}
        return found

    def state(self, where: Column | None = None, upto: int | None = None) -> DataFrame:
        """Current state with tombstones; ``where`` restricts the parts read.

        Parts without open deltas are read as they are; right after a compaction those are all, and nothing is
        shuffled. Of the other parts the base is scanned once for the rows and once more for its keys alone; both times
        the latest changes join by key, and Catalyst broadcasts them while their files are small.
        A change older than its base row loses.
        """
        now = self._manifest()
        open_deltas = self.open_deltas(now, upto)
        if not open_deltas:
            return self._base(now.parts, where)
        by = [*self.identity, *self.part_names]
        latest = self._deltas(open_deltas, where)
        if len(open_deltas) > 1:  # a single delta already has one row per identity
            latest = latest_change_per_key(latest, by)
        touched = self._touched(open_deltas)
        met = {p: v for p, v in now.parts.items() if p in touched}
        calm = {p: v for p, v in now.parts.items() if p not in touched}
        merged = self._merge(self._base(met, where), latest, by) if met else latest
        return merged.unionByName(self._base(calm, where)) if calm else merged

    def _merge(self, base: DataFrame, latest: DataFrame, by: list[str]) -> DataFrame:
        order = change_order(self.schema, by)
        rest = [c for c in self.schema.names if c not in by]
        newer = latest.select(*by, order.alias("_delta"), F.struct(*rest).alias("_new"))
        newer, on = same_keys(base, newer, by)
        joined = base.withColumns({"_base": order, "_old": F.struct(*rest)}).join(newer, on, "left")
        stays = F.col("_delta").isNull() | (F.col("_base") >= F.col("_delta"))
        rows = joined.select(*by, F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("_w"))
        merged = rows.select(*[F.col(c) if c in by else F.col(f"_w.{c}").alias(c) for c in base.columns])
        keys, on = same_keys(latest, base.select(*by), by)
        return merged.unionByName(latest.join(keys, on, "left_anti"))

    def fold(self, share: float = BASE_SHARE) -> list[tuple]:
        """Keep open deltas few at a cost that grows with the batches, not with the table; returns the parts of the base rewritten.

        While the open deltas are less than ``share`` of the base parts they touch, the newest are folded into one delta, up
        to an older one larger than all of them together: so a row is rewritten about as often as the deltas' size
        doubles. Beyond that share all go into the base (:meth:`compact`).
        """
        now = self._manifest()
        open_deltas = self.open_deltas(now)
        sizes = {d: folder_bytes(self.spark, f"{self.root}/delta/{d.name}") for d in open_deltas}
        touched = self._touched(open_deltas)
        base = sum(folder_bytes(self.spark, self._base_folder(p, v)) for p, v in now.parts.items() if p in touched)
        if sum(sizes.values()) >= share * base:
            return self.compact()
        run: list[Delta] = []
        for d in reversed(open_deltas):
            if run and sizes[d] > sum(sizes[r] for r in run):
                break
            run.append(d)
        if len(run) > 1:
            last = max(run, key=lambda d: d.number)
            merged = latest_change_per_key(self._deltas(run, None), [*self.identity, *self.part_names])
            self._commit(merged, last._replace(attempt=f"{_RUN}{uuid.uuid4().hex}"))
            folded = (now.folded | {d.name for d in run}) & {d.name for d in self._marks()}
            last_number = max(now.last_number, last.number)
            self._write_manifest(now._replace(version=now.version + 1, folded=folded, last_number=last_number))
        return []

    def compact(self) -> list[tuple]:
        """Fold all open deltas into new versions of the parts they touch; returns those parts.

        Tombstones stay in the base, so a late older change cannot bring a deleted row back; use
        :meth:`purge_tombstones` once nothing older can arrive.
        """
        now = self._manifest()
        open_deltas = self.open_deltas(now)
        if not open_deltas:
            return []
        touched = self._touched(open_deltas)
        version = now.version + 1
        if touched:
            old = self._base({p: v for p, v in now.parts.items() if p in touched}, None)
            self._rewrite(old.unionByName(self._deltas(open_deltas, None)), version, len(touched))
        written = self._parts_in(f"{self.root}/base/version={version}", version) if touched else {}
        folded = (now.folded | {d.name for d in open_deltas}) & {d.name for d in self._marks()}
        last = max([now.last_number, *[d.number for d in open_deltas]])
        self._write_manifest(Manifest(version, now.epoch, folded, now.parts | written, last, last, None))
        return sorted(touched)

    def _rewrite(self, rows: DataFrame, version: int, n_parts: int) -> None:
        merged = self._merged(rows, n_parts).select(*self.schema.names)
        writer = merged.write.mode("overwrite").partitionBy(*self.part_names)
        writer.parquet(f"{self.root}/base/version={version}")

    def _merged(self, rows: DataFrame, n_parts: int) -> DataFrame:
        """Latest row per identity, laid out for writing by part with one shuffle.

        Rows of an identity meet in a slice of their part, and grouping by part, slice and identity is
        satisfied with that. Slices keep the tasks at the shuffle width however few the parts; no
        key is hot, as base and batches hold an identity once each.
        """
        slices = max(1, shuffle_width(self.spark) // max(1, n_parts))
        sliced = rows.withColumn("_slice", F.pmod(F.hash(*self.identity), F.lit(slices)))
        by = [*self.part_names, "_slice"]
        return latest_change_per_key(sliced.repartition(*[F.col(c) for c in by]), [*by, *self.identity])

    def vacuum(self, keep: int = 2) -> int:
        """Delete files that the last ``keep`` versions do not need; returns the folders deleted.

        Keep enough versions for the longest read under way. Folded deltas and those of earlier epochs go with
        their marks, so the small metadata stays short. Deltas without a mark are failed attempts and go too: as there
        is one writer, none can be under way while it vacuums.
        """
        versions = self._versions()
        kept = [self._manifest(v) for v in versions[-keep:]]
        if not kept:
            return 0
        folded = frozenset.intersection(*[m.folded for m in kept])
        doomed = []
        for d in self._marks():
            if d.epoch < kept[0].epoch or d.name in folded:
                doomed += [f"{self.root}/{kind}/{d.name}" for kind in ("commit", "delta")]
        marked = {d.name for d in self._marks()}
        doomed += [f"{self.root}/delta/{n}" for n in child_folders(self.spark, f"{self.root}/delta") if n not in marked]
        needed = {self._base_folder(p, v) for m in kept for p, v in m.parts.items()}
        for v in versions[:-keep]:
            old = self._manifest(v)
            doomed += [f for f in (self._base_folder(p, n) for p, n in old.parts.items()) if f not in needed]
            doomed.append(f"{self.root}/manifest/version={v}")
        return sum(delete_folder(self.spark, folder) for folder in dict.fromkeys(doomed))

    def purge_tombstones(self, before_seq: int) -> int:
        """Rewrite the parts that hold tombstones older than ``before_seq`` without them; returns their number."""
        self.compact()
        now = self._manifest()
        dead = (F.col(OP) == DELETE) & (F.col(SEQ) < before_seq)
        rows = self._base(now.parts, None)
        stale = {tuple(r) for r in rows.where(dead).select(*self.part_names).distinct().collect()}  # at most all parts
        if not stale:
            return 0
        version = now.version + 1
        path = f"{self.root}/base/version={version}"
        self._write_parts(self._base({p: v for p, v in now.parts.items() if p in stale}, ~dead), path)
        parts = {p: v for p, v in now.parts.items() if p not in stale} | self._parts_in(path, version)
        self._write_manifest(now._replace(version=version, parts=parts))
        return len(stale)


def _state_row(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(OP, StringType()), StructField(SEQ, LongType())])


class KeyedTable:
    """One keyed table: load a snapshot, apply batches of changes, read the rows alive."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], schema: StructType, buckets: int = 64):
        missing = [k for k in keys if k not in schema.names]
        if missing or not keys:
            raise ValueError(f"a keyed table needs its key among its columns; missing: {missing}")
        self.keys = list(keys)
        self.columns = schema.names
        self.buckets = buckets
        parts = StructType([StructField(BUCKET, IntegerType())])
        self.store = MergeStore(spark, root, keys, _state_row(schema), parts)

    def _placed(self, rows: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.store.schema.fields}
        typed = [F.col(c).cast(kinds[c]).alias(c) if rows.schema[c].dataType != kinds[c] else F.col(c) for c in (*self.columns, OP, SEQ)]
        return rows.select(*typed).withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _known(self, rows: DataFrame, ignore: Sequence[str]) -> DataFrame:
        """Rows with the table's columns; any other column is an error unless it is named in ``ignore``."""
        unknown = [c for c in rows.columns if c not in {*self.columns, OP, SEQ, *ignore}]
        if unknown:
            raise ValueError(f"columns the table does not have: {unknown}; add them (change_schema) or name them in ignore")
        return rows

    def change_schema(self, schema: StructType) -> None:
        """Take new columns and wider types; rows written before have null in new columns."""
        self.store.change_schema(_state_row(schema))
        self.columns = schema.names

    def load(self, snapshot: DataFrame, snapshot_seq: int = -1) -> None:
        """Start from a snapshot; columns that the table does not have are left out."""
        self.store.put_base(self._placed(as_state(snapshot, snapshot_seq)))

    def apply(self, changes: DataFrame, batch_id: int, ignore: Sequence[str] = ()) -> None:
        """Upsert and delete by key; last write wins, and the same batch may be applied again.

        A column that the table does not have is an error unless ``ignore`` names it, and so is an op other than r, c, u and d.
        """
        self.store.put_delta(self._placed(self._known(changes, ignore)), batch_id)

    def state(self, upto: int | None = None) -> DataFrame:
        return self.store.state(upto=upto).drop(BUCKET)

    def read(self, upto: int | None = None) -> DataFrame:
        return live_rows(self.state(upto)).select(*self.columns)

    def vacuum(self, keep: int = 2) -> int:
        return self.store.vacuum(keep)

    def purge_tombstones(self, before_seq: int) -> int:
        return self.store.purge_tombstones(before_seq)

    def compact(self) -> int:
        """Fold deltas into the base; returns the number of buckets rewritten."""
        return len(self.store.compact())

    def fold(self, share: float = BASE_SHARE) -> int:
        """Fold deltas into one another, or into the base where they have come to ``share`` of it."""
        return len(self.store.fold(share))
