"""Times as microseconds since 1970, and periods taken from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.schema import PLAUSIBLE_FROM_US, PLAUSIBLE_TO_US

# Fixed value: the first year-month with a real month in a name.
PERIOD_PATTERN = r"(\d{4})-(0[1-9]|1[0-2])"


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division that cuts toward zero."""
    return F.call_function("div", value, F.lit(divisor))


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def iso_utc(us: Column) -> Column:
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_seconds(us: Column) -> Column:
    """To the second; "n/a" where there is no positive time."""
    text = F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(us > 0, text).otherwise("n/a")


def is_plausible(us: Column) -> Column:
    return us.between(PLAUSIBLE_FROM_US, PLAUSIBLE_TO_US)


def normalize_epoch_us(value: Column) -> Column:
    """Guess the unit of an integer epoch from its size and scale it to microseconds.

    For integer columns only: a real timestamp already says its unit, and one
    before 1973-03 would be taken for milliseconds.
    """

    def below(limit: int) -> Column:
        return (value > -limit) & (value < limit)

    # The sizes at which one unit ends and the next begins.
    already = is_plausible(value) | value.between(-PLAUSIBLE_TO_US, -PLAUSIBLE_FROM_US)
    return (
        F.when(already, value)
        .when(below(10**11), value * 1_000_000)
        .when(below(10**14), value * 1_000)
        .when(below(10**17), value)
        .otherwise(whole_div(value, 1_000))
    )


def epoch_micros(column: Column, dtype: str) -> Column:
    """A time column of any stored type as microseconds; null where it has none."""
    if dtype == "date":
        return F.unix_date(column).cast("bigint") * 86_400_000_000
    if dtype in ("timestamp", "timestamp_ntz"):
        return to_micros(column)
    if dtype == "string":
        return to_micros(column.try_cast("timestamp_ntz"))
    return normalize_epoch_us(column.try_cast("bigint"))


def period_from_name(name: Column) -> tuple[Column, Column]:
    """(year, month) of a file name; both null when the name holds none."""
    year = F.regexp_extract(name, PERIOD_PATTERN, 1).try_cast("int")
    month = F.regexp_extract(name, PERIOD_PATTERN, 2).try_cast("int")
    return year, month


def period_number(name: Column) -> Column:
    """yyyymm of a file name, from a single match; null when the name holds none."""
    found = F.regexp_extract(name, PERIOD_PATTERN, 0)
    return F.replace(found, F.lit("-"), F.lit("")).try_cast("int")


def in_period(ts: Column, period: int) -> Column:
    """The wall-clock time falls into the month yyyymm; a range of literals, which scans can use."""
    year, month = divmod(period, 100)
    after = (year + month // 12, month % 12 + 1)
    low, high = (F.expr(f"timestamp_ntz'{y:04d}-{m:02d}-01 00:00:00'") for y, m in ((year, month), after))
    return (ts >= low) & (ts < high)


def period_label(name: Column) -> Column:
    """`YYYY-MM`, or the name without its ending."""
    found = F.regexp_extract(name, PERIOD_PATTERN, 0)
    return F.when(found != "", found).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
