"""Monthly and yearly counts and their change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.times import first_of_month


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar month of a time column; rows without a time are left out."""
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
        .agg(F.count("*").alias("row_count"))
    )


def with_change(counts: DataFrame) -> DataFrame:
    """Add the month's date and the change against the previous row.

    The previous row is the previous month or file present: gaps are not filled.
    The window has no partition, as it runs over one row per month or file and
    not over trips.
    """
    tie = ["file"] if "file" in counts.columns else []
    in_order = Window.orderBy("year", "month", *tie)
    previous = F.lag("row_count").over(in_order)
    ratio = F.try_divide(F.col("row_count").cast("double"), previous.cast("double"))
    return counts.withColumns(
        {
            "date": first_of_month(F.col("year"), F.col("month")),
            "mom_change": F.col("row_count") - previous,
            "mom_change_pct": (ratio - 1) * 100,
        }
    ).orderBy("year", "month", *tie)


def monthly_stats(counts: DataFrame) -> DataFrame:
    return with_change(counts).select("date", "row_count", "mom_change", "mom_change_pct")


def yearly_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("year").agg(F.sum("row_count").alias("row_count")).orderBy("year")


def grand_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("row_count").alias("total_rows"))


def coverage(counts: DataFrame) -> DataFrame:
    """First and last month, and how many rows the count table has."""
    date = first_of_month(F.col("year"), F.col("month"))
    return counts.agg(
        F.min(date).alias("first_month"),
        F.max(date).alias("last_month"),
        F.count("*").alias("n_months"),
    )
