"""Several keyed tables fed by one stream of tagged changes and sharing one progress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    CalendarIntervalType,
    DataType,
    DayTimeIntervalType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
    YearMonthIntervalType,
)

from rowtide.functions.digests import row_text
from rowtide.operators.changes import OP, SEQ, as_state, live_rows
from rowtide.sources.merge_store import BASE_SHARE, BUCKET, TABLE_NAME, MergeStore, bucket_of

ROW_KEY = "row_key"
PAYLOAD = "payload"


def _as_variant(kind: DataType) -> bool:
    """Whether values of a type come back from a variant as they were."""
    if isinstance(kind, StructType):
        return all(_as_variant(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _as_variant(kind.elementType)
    if isinstance(kind, MapType):
        return isinstance(kind.keyType, StringType) and _as_variant(kind.valueType)
    return not isinstance(kind, (DayTimeIntervalType, YearMonthIntervalType, CalendarIntervalType))


@dataclass(frozen=True)
class TableSpec:
    keys: Sequence[str]
    schema: StructType


def tagged(changes: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Changes of one table in the shape of the shared feed: its row is a struct named like it."""
    quoted = [F.col(f"`{c.replace('`', '``')}`").alias(c) for c in columns]
    return changes.select(F.lit(table).alias(TABLE_NAME), OP, SEQ, F.struct(*quoted).alias(table))


def tagged_union(parts: Sequence[DataFrame]) -> DataFrame:
    """One feed of many tables; the structs of the other tables are null in a row."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


class TableSet:
    """Tables of one job. A batch of all tables is one write and one commit mark.

    Readers see the same last batch in every table. A row's columns are stored as one variant, whatever its table, so
    neither files nor aggregates grow wider with the number of tables; :meth:`read` gives them their types again.
    """

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, TableSpec], buckets: int = 16):
        self.tables = dict(tables)
        refused = [f"{t}.{f.name}" for t, spec in self.tables.items() for f in spec.schema.fields if not _as_variant(f.dataType)]
        if refused:
            raise ValueError(f"columns that a set of tables cannot keep (maps need text keys, intervals have no variant form): {refused}")
        self.buckets = buckets
        row = StructType(
            [
                StructField(ROW_KEY, StringType()),
                StructField(OP, StringType()),
                StructField(SEQ, LongType()),
                StructField(PAYLOAD, VariantType()),
            ]
        )
        parts = StructType([StructField(TABLE_NAME, StringType()), StructField(BUCKET, IntegerType())])
        self.store = MergeStore(spark, root, [ROW_KEY], row, parts)

    def feed_schema(self) -> StructType:
        """Schema of the tagged feed, for a stream to read it by."""
        common = [StructField(TABLE_NAME, StringType()), StructField(OP, StringType()), StructField(SEQ, LongType())]
        return StructType([*common, *[StructField(name, spec.schema) for name, spec in self.tables.items()]])

    def _placed(self, feed: DataFrame) -> DataFrame:
        def key_of(name: str, spec: TableSpec):
            fields = [F.col(name).getField(k) for k in spec.keys]
            return F.when(F.col(TABLE_NAME) == name, row_text(fields, [spec.schema[k].dataType for k in spec.keys]))

        unknown = F.raise_error(F.concat(F.lit("change of a table that is not in the set: "), F.coalesce(TABLE_NAME, F.lit("null"))))
        key = F.coalesce(*[key_of(n, s) for n, s in self.tables.items()], unknown.cast("string"))
        payload = F.coalesce(*[F.when(F.col(TABLE_NAME) == n, F.to_variant_object(F.col(n))) for n in self.tables])
        placed = feed.select(TABLE_NAME, OP, SEQ, key.alias(ROW_KEY), payload.alias(PAYLOAD))
        return placed.withColumn(BUCKET, bucket_of([ROW_KEY], self.buckets))

    def load(self, snapshots: Mapping[str, DataFrame], snapshot_seq: int = -1) -> None:
        parts = [
            tagged(as_state(df, snapshot_seq), name, self.tables[name].schema.names)
            for name, df in snapshots.items()
        ]
        missing = [n for n in self.tables if n not in snapshots]
        feed = tagged_union(parts)
        for name in missing:
            feed = feed.withColumn(name, F.lit(None).cast(self.tables[name].schema))
        self.store.put_base(self._placed(feed))

    def apply(self, feed: DataFrame, batch_id: int) -> None:
        """Apply a tagged feed; rows of tables outside the set make the batch fail, see :meth:`known_rows`."""
        self.store.put_delta(self._placed(feed), batch_id)

    def known_rows(self, feed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """A feed's rows of the set's tables, and those of other or unnamed tables, to be kept elsewhere."""
        known = F.coalesce(F.col(TABLE_NAME).isin(list(self.tables)), F.lit(False))
        return feed.where(known), feed.where(~known)

    def read(self, table: str, upto: int | None = None) -> DataFrame:
        """Rows alive in one table; only its folders are read."""
        state = self.store.state(F.col(TABLE_NAME) == table, upto)
        fields = [f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for f in self.tables[table].schema.fields]
        row = F.variant_get(PAYLOAD, "$", f"struct<{', '.join(fields)}>")
        return live_rows(state).select(row.alias("_row")).select("_row.*")

    def compact(self) -> int:
        return len(self.store.compact())

    def fold(self, share: float = BASE_SHARE) -> int:
        """Fold deltas into one another, or into the base where they have come to ``share`` of it."""
        return len(self.store.fold(share))

    def vacuum(self, keep: int = 2) -> int:
        return self.store.vacuum(keep)

    def purge_tombstones(self, before_seq: int) -> int:
        return self.store.purge_tombstones(before_seq)
