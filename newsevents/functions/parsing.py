"""Typed conversion of feed tokens: empty or unparseable -> null.

All helpers return JVM-side column expressions (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsevents.schema import DATE_FORMAT


def blank_to_null(c: Column) -> Column:
    """Empty token -> null, other strings unchanged."""
    return F.nullif(c, F.lit(""))


# A failed cast throws (and catches) a JVM exception per value; a regex test
# in front keeps bad or empty tokens on the cheap path.
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DOUBLE_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*$"


def to_int(c: Column) -> Column:
    return F.when(c.rlike(INT_TEXT), c.try_cast("int"))


def to_long(c: Column) -> Column:
    return F.when(c.rlike(INT_TEXT), c.try_cast("bigint"))


def to_double(c: Column) -> Column:
    # Digits only: "NaN" / "Infinity" spelled out in a feed are not taken.
    return F.when(c.rlike(DOUBLE_TEXT), c.try_cast("double"))


def to_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Strict ``yyyyMMdd``: month 13 or trailing junk give null."""
    return F.try_to_date(c, fmt)


def to_bool(c: Column) -> Column:
    """``"1"`` -> true, any other non-empty token -> false, empty -> null."""
    return F.when(c != F.lit(""), c == F.lit("1"))


def convert(c: Column, kind: str) -> Column:
    """Dispatch on a type name used by the schema tables."""
    if kind == "string":
        return blank_to_null(c)
    if kind == "int":
        return to_int(c)
    if kind == "bigint":
        return to_long(c)
    if kind == "double":
        return to_double(c)
    if kind == "date":
        return to_date(c)
    if kind == "boolean":
        return to_bool(c)
    raise ValueError(f"unknown type {kind!r}")


def split_all(c: Column, sep: str) -> Column:
    """Split keeping trailing empty tokens (limit -1); ``sep`` is a regex."""
    return F.split(c, sep, -1)


def non_blank_items(c: Column, sep: str) -> Column:
    """Delimited list -> array without blank items; null/empty input -> []."""
    items = F.filter(split_all(F.coalesce(c, F.lit("")), sep), lambda x: x != F.lit(""))
    return items
