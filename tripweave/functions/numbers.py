"""Rounding as fixed-decimal text rounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1e6

# Splits a double into two parts whose products with SCALE are exact.
SPLITTER = 134217729.0

# Beyond this neighbouring doubles lie more than a millionth apart, so that every
# value already is the nearest to its six decimals.
LARGEST = 2.0**53 / SCALE


def fixed_decimals(value: Column) -> Column:
    """`value` rounded to six decimals by its exact binary value, ties to even.

    The built-in round goes by the shortest decimal text instead, which turns
    40.7001875, stored a little below that, upward. Scaling can only go wrong by
    landing exactly between two whole numbers, so that case looks at what the
    multiplication lost.
    """
    scaled = value * SCALE
    nearest = F.rint(scaled)
    high = value * SPLITTER - (value * SPLITTER - value)
    lost = (high * SCALE - scaled) + (value - high) * SCALE
    between = (F.abs(scaled - nearest) == 0.5) & (lost != 0)
    whole = F.when(between, scaled + F.signum(lost) * 0.5).otherwise(nearest)
    return F.when(F.abs(value) < LARGEST, whole / SCALE).otherwise(value)
