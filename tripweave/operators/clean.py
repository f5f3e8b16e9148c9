"""Conform drifting schemas to the canonical one and drop rows that fail the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.times import from_micros
from tripweave.schema import (
    DROPOFF,
    DROPOFF_ZONE,
    PICKUP,
    PICKUP_ZONE,
    SENTINEL_ZONES,
    TRIP_ALIASES,
    TRIP_SCHEMA,
)


def source_column(name: str, available: list[str], aliases: dict[str, list[str]]) -> str | None:
    """The column that feeds a canonical one, by its own name first."""
    for candidate in [name, *aliases.get(name, [])]:
        if candidate in available:
            return candidate
    return None


def conform(
    df: DataFrame,
    target: T.StructType = TRIP_SCHEMA,
    aliases: dict[str, list[str]] = TRIP_ALIASES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Select `target` in its order: renamed, cast, and null where a column is missing.

    A value its type cannot hold becomes null. Of what should be a time, a whole
    number counts microseconds, and other numbers and truth values become null.
    `keep` names columns to carry along.
    """
    stored = dict(df.dtypes)
    columns = []
    for field in target.fields:
        source = source_column(field.name, df.columns, aliases)
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        if field.dataType == T.TimestampNTZType():
            value = as_time(value, stored.get(source, "void"))
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns, *[F.col(name) for name in keep])


def as_time(value: Column, stored: str) -> Column:
    """What can be cast to a time: texts and times as they are, whole numbers as microseconds."""
    if stored in ("tinyint", "smallint", "int", "bigint"):
        return from_micros(value.cast("bigint"))
    if stored in ("string", "void", "date", "timestamp", "timestamp_ntz"):
        return value
    return F.lit(None).cast("timestamp_ntz")


def in_month(ts: Column, period: Column) -> Column:
    """The time falls into the month given as yyyymm; true where there is none.

    Names the period once, as it is usually drawn from a file name for every row.
    """
    actual = F.year(ts) * 100 + F.month(ts)
    return F.coalesce(period, actual) == actual


def has_real_zones(*zones: Column, sentinels: list[int] = SENTINEL_ZONES) -> Column:
    """No zone is a sentinel. A null zone is not one, so its row stays."""
    keep = F.lit(True)
    for zone in zones:
        keep = keep & ~F.coalesce(zone.isin(sentinels), F.lit(False))
    return keep


def has_valid_times(pickup: Column, dropoff: Column) -> Column:
    return dropoff >= pickup


def clean_rule(
    pickup: str = PICKUP,
    dropoff: str = DROPOFF,
    pickup_zone: str = PICKUP_ZONE,
    dropoff_zone: str = DROPOFF_ZONE,
    period: Column | None = None,
    sentinels: list[int] = SENTINEL_ZONES,
) -> Column:
    """In the labelled month, between real zones, and not ending before it starts."""
    rule = has_valid_times(F.col(pickup), F.col(dropoff))
    rule = rule & has_real_zones(F.col(pickup_zone), F.col(dropoff_zone), sentinels=sentinels)
    return rule if period is None else rule & in_month(F.col(pickup), period)


def clean(
    df: DataFrame,
    pickup: str = PICKUP,
    dropoff: str = DROPOFF,
    pickup_zone: str = PICKUP_ZONE,
    dropoff_zone: str = DROPOFF_ZONE,
    period: Column | None = None,
    sentinels: list[int] = SENTINEL_ZONES,
) -> DataFrame:
    """The rows that meet every rule; a rule that comes out null drops its row."""
    return df.where(clean_rule(pickup, dropoff, pickup_zone, dropoff_zone, period, sentinels))


def kept_counts(df: DataFrame, rule: Column, by: list[str]) -> DataFrame:
    """Rows seen and rows kept per source."""
    return df.groupBy(*by).agg(
        F.count("*").alias("rows_in"), F.count_if(rule).alias("rows_kept")
    )
