"""Date-based trip ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.numbering import TASK_ROWS, number_in_buckets
from tripweave.schema import MAX_SEQUENCE, PICKUP, SOURCE_FILE, SOURCE_ROW, TRIP_ID


def add_trip_id(
    df: DataFrame,
    pickup: str = PICKUP,
    group: list[str] | None = None,
    tie_break: list[str] | None = None,
    max_seq: int = MAX_SEQUENCE,
    bucket_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add `trip_id`: yymmdd * 1e9 + position in the day, in pickup order.

    Positions restart in every `group` (by default the source file). Equal pickups
    follow `tie_break`. A row without a pickup gets no id. Trips are numbered hour
    by hour, and busy hours in smaller pieces, so that no day or instant has to
    fit one task.
    """
    group = [SOURCE_FILE] if group is None else group
    tie_break = [SOURCE_ROW] if tie_break is None else tie_break
    if pickup not in df.columns:
        raise ValueError(f"missing column {pickup}")
    if TRIP_ID in df.columns:
        raise ValueError(f"the rows already have {TRIP_ID}")

    days = df.withColumn("_day", F.to_date(pickup))
    instant = F.col(pickup).cast("timestamp_ntz")
    hour = F.hour(instant)
    numbered = number_in_buckets(days, [*group, "_day"], hour, instant, tie_break, "_seq", bucket_rows)
    sequence = checked_sequence(F.col("_seq"), max_seq)
    identified = F.when(F.col("_day").isNotNull(), trip_id(F.col("_day"), sequence))
    return numbered.withColumn(TRIP_ID, identified).drop("_day", "_seq")


def trip_id(day: Column, sequence: Column) -> Column:
    prefix = F.year(day) % 100 * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
    return prefix.cast("bigint") * MAX_SEQUENCE + sequence


def over_limit(sequence: Column, max_seq: int) -> Column:
    """The position is one that no id can be made of."""
    return sequence > max_seq


def checked_sequence(sequence: Column, max_seq: int) -> Column:
    problem = F.concat(F.lit("more trips in a day than "), F.lit(str(max_seq)))
    return F.when(over_limit(sequence, max_seq), F.raise_error(problem)).otherwise(sequence)
