"""Value conversions per source type, and the checks that tell which values do not fit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions.typemap import (
    DEFAULT_BINARY_LENGTH,
    DEFAULT_LENGTH,
    DEFAULT_PRECISION,
    DEFAULT_SCALE,
    MAX_LENGTH,
)

GUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\\z"
IMAGE_HEX_LENGTH = 2000
GUID_LENGTH = 36
MICROS = 6


@dataclass(frozen=True)
class ColumnSpec:
    """Declared type of one column."""

    name: str
    source_type: str
    nullable: bool = True
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    truncate: bool = False
    stored_as: str = ""  # Spark type of the column, where known: lets range checks replace failing casts

    @property
    def max_length(self) -> int:
        if self.length == -1:
            return MAX_LENGTH
        return DEFAULT_LENGTH if self.length is None else self.length

    @property
    def hex_length(self) -> int:
        return 2 * (self.length or DEFAULT_BINARY_LENGTH) if self.length != -1 else 2 * MAX_LENGTH

    @property
    def digits(self) -> tuple[int, int]:
        precision = DEFAULT_PRECISION if self.precision is None else self.precision
        return precision, DEFAULT_SCALE if self.scale is None else self.scale

    @property
    def fraction(self) -> int:
        """Digits kept behind the second; all that Spark stores unless declared otherwise."""
        return MICROS if self.scale is None else min(self.scale, MICROS)


Conversion = Callable[[Column, ColumnSpec], Column]

# Value ranges of the whole-number types, and types whose values compare as numbers.
_RANGES = {"smallint": 2**15, "int": 2**31, "bigint": 2**63}
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_EXACT_IN_DOUBLE = 15


def _cast(kind: str) -> Conversion:
    return lambda c, spec: c.try_cast(kind)


def _in_range(c: Column, spec: ColumnSpec, kind: str, low: float, high: float) -> Column:
    """``try_cast`` of values strictly between the bounds.

    A failing cast raises inside Spark, once per row; comparing first keeps a column full of
    numbers out of range as fast as a clean one.
    """
    cast = c.try_cast(kind)
    if spec.stored_as.split("(")[0] not in _NUMERIC:
        return cast
    return F.when((c > F.lit(low)) & (c < F.lit(high)), cast)


def _whole(kind: str) -> Conversion:
    limit = _RANGES[kind]

    def convert(c: Column, spec: ColumnSpec) -> Column:
        if kind == "bigint":  # the bounds themselves do not fit a whole number
            return c.try_cast(kind)
        return _in_range(c, spec, kind, -limit - 1, limit)

    return convert


def _decimal_of(precision: int, scale: int) -> Conversion:
    def convert(c: Column, spec: ColumnSpec) -> Column:
        kind = f"decimal({precision},{scale})"
        if precision > _EXACT_IN_DOUBLE:
            return c.try_cast(kind)
        bound = float(10 ** (precision - scale))
        return _in_range(c, spec, kind, -bound, bound)

    return convert


def _decimal(c: Column, spec: ColumnSpec) -> Column:
    precision, scale = spec.digits
    return _decimal_of(precision, scale)(c, spec)


def _tinyint(c: Column, spec: ColumnSpec) -> Column:
    wide = _whole("smallint")(c, spec)
    return F.when(wide.between(0, 255), wide)


def _padded(c: Column, spec: ColumnSpec) -> Column:
    text = c.cast("string")
    full = F.length(text) >= spec.max_length
    kept = F.substring(text, 1, spec.max_length) if spec.truncate else text
    return F.when(full, kept).otherwise(F.rpad(text, spec.max_length, " "))


def _text(c: Column, spec: ColumnSpec) -> Column:
    text = c.cast("string")
    return F.substring(text, 1, spec.max_length) if spec.truncate else text


def _string(c: Column, spec: ColumnSpec) -> Column:
    return c.cast("string")


def truncated(ts: Column, digits: int) -> Column:
    """A wall-clock time cut to ``digits`` behind the second, without passing a time zone."""
    if digits >= MICROS:
        return ts
    seconds = F.extract(F.lit("SECOND"), ts)
    unit = F.lit(10**digits)
    surplus = seconds - (F.floor(seconds * unit) / unit).cast("decimal(8,6)")
    return ts - F.make_dt_interval(secs=surplus.cast("decimal(18,6)"))


def _wall_clock(digits: int | None) -> Conversion:
    return lambda c, spec: truncated(
        c.try_cast("timestamp_ntz"), spec.fraction if digits is None else digits
    )


def _instant(c: Column, spec: ColumnSpec) -> Column:
    return truncated(c.try_cast("timestamp"), spec.fraction)


def _time_of_day(c: Column, spec: ColumnSpec) -> Column:
    """``HH:mm:ss.f…`` as text; bare times are read on an arbitrary day."""
    text = c.cast("string")
    bare = F.when(text.rlike("^\\d{1,2}:"), F.concat(F.lit("1970-01-01 "), text)).otherwise(text)
    stamp = bare.try_cast("timestamp_ntz").cast("string")
    digits = spec.fraction
    if digits == 0:
        return F.substring(stamp, 12, 8)
    fraction = F.rpad(F.substring(stamp, 21, digits), digits, "0")
    return F.concat(F.substring(stamp, 12, 8), F.lit("."), fraction)


def _hex(c: Column, spec: ColumnSpec) -> Column:
    """Binary as upper-case hex text."""
    return F.hex(c.cast("binary"))


_CONVERSIONS: dict[str, Conversion] = {
    "tinyint": _tinyint,
    "decimal": _decimal,
    "numeric": _decimal,
    "money": _decimal_of(19, 4),
    "smallmoney": _decimal_of(10, 4),
    "float": _cast("double"),
    "real": _cast("float"),
    "bit": _cast("boolean"),
    "datetime": _wall_clock(3),
    "datetime2": _wall_clock(None),
    "smalldatetime": _wall_clock(0),
    "datetimeoffset": _instant,
    "time": _time_of_day,
    "binary": _cast("binary"),
    "varbinary": _hex,
    "image": _hex,
}
_CONVERSIONS |= {kind: _whole(kind) for kind in _RANGES} | {"date": _cast("date")}
_CONVERSIONS |= {kind: _padded for kind in ("char", "nchar")}
_CONVERSIONS |= {kind: _text for kind in ("varchar", "nvarchar")}
_CONVERSIONS |= {kind: _string for kind in ("text", "ntext", "xml", "json", "uniqueidentifier")}


# Registered by callers; they go before the built-in ones.
_CUSTOM: dict[str, Conversion] = {}

# Conversions to text or from any bytes; there is no value they refuse.
_NEVER_FAIL = {"char", "nchar", "varchar", "nvarchar", "text", "ntext", "xml", "varbinary", "image"}


def register_conversion(source_type: str, conversion: Conversion) -> None:
    """Add or replace the conversion of a source type.

    ``conversion(column, spec)`` returns a ``Column``: a native expression, or a call of an
    Arrow ``pandas_udf`` where no native one can say it.
    """
    _CUSTOM[source_type.lower()] = conversion


def unregister_conversion(source_type: str) -> None:
    """Take back what was registered; a built-in conversion it replaced is in force again."""
    _CUSTOM.pop(source_type.lower(), None)


def is_mapped(source_type: str) -> bool:
    return source_type.lower() in _CUSTOM or source_type.lower() in _CONVERSIONS


def converted(value: Column, spec: ColumnSpec) -> Column:
    """The value in its mapped type; null where it cannot be converted; text if unmapped."""
    kind = spec.source_type.lower()
    return _CUSTOM.get(kind, _CONVERSIONS.get(kind, _string))(value, spec)


def _over_length(value: Column, spec: ColumnSpec) -> Column | None:
    kind = spec.source_type.lower()
    text = value.cast("string")
    if kind in ("char", "nchar", "varchar", "nvarchar"):
        return F.length(text) > spec.max_length
    if kind == "uniqueidentifier":
        return F.length(text) > GUID_LENGTH
    if kind == "binary":
        return F.length(value.cast("binary")) > spec.max_length
    if kind == "varbinary":
        return F.length(value.cast("binary")) * 2 > spec.hex_length
    if kind == "image":
        return F.length(value.cast("binary")) * 2 > IMAGE_HEX_LENGTH
    return None


def violations(value: Column, spec: ColumnSpec) -> dict[str, Column]:
    """Named boolean tests, each true where the value breaks its declaration."""
    kind = spec.source_type.lower()
    found = {}
    if is_mapped(kind) and (kind in _CUSTOM or kind not in _NEVER_FAIL):
        found["failed_cast"] = value.isNotNull() & converted(value, spec).isNull()
    if kind == "uniqueidentifier":
        found["failed_cast"] = ~value.cast("string").rlike(GUID)
    elif kind == "json":
        text = value.cast("string")
        found["failed_cast"] = value.isNotNull() & F.try_parse_json(text).isNull()
    if not spec.nullable:
        found["null_in_not_null"] = value.isNull()
    too_long = _over_length(value, spec)
    if too_long is not None:
        found["over_length"] = too_long
    return {name: F.coalesce(test, F.lit(False)) for name, test in found.items()}
