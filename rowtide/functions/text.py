"""Name matching and text formatting as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any character but a line break.
_ANY = "[^\\n\\r\\u2028\\u2029]"

# LIKE patterns of names that belong to the source system, not to the user.
SYSTEM_NAME_PATTERNS = ("sys%", "MS%", "dt%", "trace_%")


def glob_body(pattern: str) -> str:
    """Regex body equal to a glob: ``*`` is any run, ``?`` one character, the rest literal."""
    wild = {"*": f"{_ANY}*", "?": _ANY}
    return "".join(
        wild.get(ch) or (ch if ch.isalnum() or ch == "_" else f"\\{ch}") for ch in pattern.lower()
    )


def _any_of(tests: Sequence[Column]) -> Column:
    return F.coalesce(reduce(or_, tests), F.lit(False))


def glob_match(value: Column, patterns: Sequence[str] | None) -> Column:
    """Case-insensitive match against any glob; no patterns at all matches everything."""
    if not patterns:
        return F.lit(True)
    name = F.lower(value)
    plain = [p.lower() for p in patterns if not set(p) & {"*", "?"}]
    tests = [name.isin(plain)] if plain else []
    tests += [name.rlike(f"^{glob_body(p)}\\z") for p in patterns if set(p) & {"*", "?"}]
    return _any_of(tests)


def regex_match(value: Column, patterns: Sequence[str] | None) -> Column:
    """Case-insensitive search (in any alphabet, as for column names) with any regular expression; no patterns matches everything."""
    if not patterns:
        return F.lit(True)
    return _any_of([value.rlike(f"(?iu){p}") for p in patterns])


MATCHERS = {"glob": glob_match, "regex": regex_match}


def selected(
    value: Column,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> Column:
    """True where a name is kept: exclusion wins, and an empty include list keeps the rest."""
    match = MATCHERS[mode]
    keep = match(value, include)
    return keep & ~match(value, exclude) if exclude else keep


def name_selected(
    name: str,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    mode: str = "glob",
) -> bool:
    """The rule of :func:`selected` for one column name, known on the driver."""

    def hit(pattern: str) -> bool:
        if mode == "glob":
            return re.fullmatch(glob_body(pattern), name.lower()) is not None
        return re.search(pattern, name, re.IGNORECASE) is not None

    if exclude and any(map(hit, exclude)):
        return False
    return any(map(hit, include)) if include else True


def is_system_name(value: Column, case_sensitive: bool = True) -> Column:
    """True for names of the source system (``_`` in a pattern stands for one character)."""
    like = (lambda p: value.like(p)) if case_sensitive else (lambda p: value.ilike(p))
    return _any_of([like(p) for p in SYSTEM_NAME_PATTERNS])


def identifier(value: Column) -> Column:
    """A name usable on the target side: hyphens become underscores."""
    return F.translate(value, "-", "_")


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` placeholders by column values."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{%s}" % name), value.cast("string"))
    return template


def grouped_number(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def fixed2(value: Column) -> Column:
    """Number with exactly two decimals and no thousands separators."""
    return value.cast("decimal(38,2)").cast("string")


def iso_millis(ts: Column) -> Column:
    """ISO-8601 text in UTC with milliseconds; ``ts`` is a UTC wall-clock timestamp."""
    text = ts.cast("timestamp_ntz").cast("string")
    fraction = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fraction, F.lit("Z"))
