"""The map from source column types to stream and target types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import fill_template

# Source type, stream type, target type.
TYPE_MAP = (
    # whole numbers
    ("tinyint", "SMALLINT", "SMALLINT"),
    ("smallint", "SMALLINT", "SMALLINT"),
    ("int", "INT", "INT"),
    ("bigint", "BIGINT", "BIGINT"),
    # exact decimals
    ("decimal", "DECIMAL({precision},{scale})", "DECIMAL({precision},{scale})"),
    ("numeric", "DECIMAL({precision},{scale})", "DECIMAL({precision},{scale})"),
    ("money", "DECIMAL(19,4)", "DECIMAL(19,4)"),
    ("smallmoney", "DECIMAL(10,4)", "DECIMAL(10,4)"),
    # floating point
    ("float", "DOUBLE", "DOUBLE"),
    ("real", "FLOAT", "FLOAT"),
    # text
    ("char", "CHAR({maxLength})", "CHAR({maxLength})"),
    ("varchar", "VARCHAR({maxLength})", "VARCHAR({maxLength})"),
    ("nchar", "CHAR({maxLength})", "CHAR({maxLength})"),
    ("nvarchar", "VARCHAR({maxLength})", "VARCHAR({maxLength})"),
    ("text", "STRING", "STRING"),
    ("ntext", "STRING", "STRING"),
    # dates and times
    ("date", "DATE", "DATE"),
    ("datetime", "TIMESTAMP(3)", "DATETIME"),
    ("datetime2", "TIMESTAMP({scale})", "DATETIME"),
    ("smalldatetime", "TIMESTAMP(0)", "DATETIME"),
    ("time", "TIME({scale})", "TIME"),
    ("datetimeoffset", "TIMESTAMP_LTZ({scale})", "DATETIME"),
    # boolean
    ("bit", "BOOLEAN", "BOOLEAN"),
    # binary
    ("binary", "BINARY({maxLength})", "BINARY"),
    ("varbinary", "VARCHAR({maxLength_times_2})", "VARBINARY"),
    ("image", "VARCHAR(2000)", "VARBINARY"),
    # others
    ("uniqueidentifier", "VARCHAR(36)", "VARCHAR(36)"),
    ("xml", "STRING", "STRING"),
    ("json", "STRING", "JSON"),
)

# Type of anything unmapped; length that stands for "max"; defaults of the placeholders.
FALLBACK_TYPE = "STRING"
MAX_LENGTH = 65535
DEFAULT_LENGTH = 255
DEFAULT_BINARY_LENGTH = 127
DEFAULT_PRECISION = 10
DEFAULT_SCALE = 0

MAP_SCHEMA = "source_type string, stream_type string, target_type string, priority int"


def type_map_frame(
    spark: SparkSession,
    custom: Sequence[tuple[str, str, str]] = (),
    custom_wins: bool = True,
) -> DataFrame:
    """The map as a frame with one row per source type.

    Where a custom entry names a mapped type, ``custom_wins`` decides which of the two stays.
    """
    order = [*custom, *TYPE_MAP] if custom_wins else [*TYPE_MAP, *custom]
    first = {}
    for rank, row in enumerate(order):
        first.setdefault(row[0], (*row, rank))
    return spark.createDataFrame(list(first.values()), MAP_SCHEMA)


def stored_length(length: Column) -> Column:
    """Declared length with -1 (``max``) replaced by its number."""
    return F.when(length == -1, F.lit(MAX_LENGTH)).otherwise(length)


def rendered_type(template: Column, length: Column, precision: Column, scale: Column) -> Column:
    """A type template with length, precision and scale filled in."""
    binary_length = F.when(length != 0, length)
    return fill_template(
        template,
        {
            "maxLength": F.coalesce(length, F.lit(DEFAULT_LENGTH)),
            "maxLength_times_2": F.coalesce(binary_length, F.lit(DEFAULT_BINARY_LENGTH)) * 2,
            "precision": F.coalesce(precision, F.lit(DEFAULT_PRECISION)),
            "scale": F.coalesce(scale, F.lit(DEFAULT_SCALE)),
        },
    )
