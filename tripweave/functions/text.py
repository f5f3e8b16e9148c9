"""Reading numbers out of loosely written text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unquote(field: Column) -> Column:
    """Trim blanks, then drop one pair of surrounding double quotes."""
    trimmed = F.regexp_replace(field, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    return F.regexp_replace(trimmed, r'^"(.*)"$', "$1")


def leading_int(field: Column) -> Column:
    """The 32-bit integer a field starts with, else null."""
    return F.regexp_extract(field, r"^\s*([+-]?\d+)", 1).try_cast("int").cast("bigint")


def leading_double(field: Column) -> Column:
    """The decimal number a field starts with, else null; null also beyond a double's range."""
    number = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
    value = F.regexp_extract(field, number, 1).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def message_key(trip_id: Column) -> Column:
    """A message key is always text, also for a missing id."""
    return F.coalesce(trip_id.cast("string"), F.lit("null"))
