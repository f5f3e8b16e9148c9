from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripweave.functions import times


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (0, 0),
        (1, 1_000_000),
        (1_600_000_000, 1_600_000_000_000_000),
        (-1_600_000_000, -1_600_000_000_000_000),
        (99_999_999_999, 99_999_999_999_000_000),
        (100_000_000_000, 100_000_000_000_000),
        (1_600_000_000_000, 1_600_000_000_000_000),
        (99_999_999_999_999, 99_999_999_999_999_000),
        (100_000_000_000_000, 100_000_000_000_000),
        (1_262_304_000_000_000, 1_262_304_000_000_000),
        (1_893_456_000_000_000, 1_893_456_000_000_000),
        (-1_600_000_000_000_000, -1_600_000_000_000_000),
        (99_999_999_999_999_999, 99_999_999_999_999_999),
        (100_000_000_000_000_000, 100_000_000_000_000),
        (1_600_000_000_000_000_999, 1_600_000_000_000_000),
        (-1_600_000_000_000_000_999, -1_600_000_000_000_000),
        (-(2**63), -9_223_372_036_854_775),
    ],
)
def test_epoch_unit_is_told_from_its_size(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v bigint")
    assert values(df.select(times.normalize_epoch_us(F.col("v")))) == [expected]


def test_time_columns_of_every_type_become_micros(spark):
    df = spark.sql(
        "select date'2020-01-02' d, timestamp_ntz'2020-01-02 03:04:05.000006' n,"
        " timestamp'2020-01-02 03:04:05' t, 1577934245 s, cast(1577934245000 as double) f,"
        " '2020-01-02 03:04:05' x, 'never' y"
    )
    kinds = dict(df.dtypes)
    out = df.select(*[times.epoch_micros(F.col(c), kinds[c]) for c in df.columns]).first()
    second = 1_577_934_245_000_000
    day = 1_577_923_200_000_000
    assert list(out) == [day, second + 6, second, second, second, second, None]


def test_early_timestamp_is_not_taken_for_millis(spark):
    df = spark.sql("select timestamp_ntz'1971-01-01 00:00:00' t")
    out = df.select(times.epoch_micros(F.col("t"), "timestamp_ntz"))
    assert values(out) == [365 * 86_400_000_000]


def test_iso_text(spark):
    df = spark.createDataFrame([(1_577_934_245_000_006,), (0,), (-5,)], "us bigint")
    rows = df.select(times.iso_utc(F.col("us")), times.iso_seconds(F.col("us"))).collect()
    assert rows[0][0] == "2020-01-02T03:04:05.000006Z"
    assert [r[1] for r in rows] == ["2020-01-02T03:04:05Z", "n/a", "n/a"]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("trips_2020-02.parquet", (2020, 2, 202002, "2020-02")),
        ("2020-13_2021-07.parquet", (2021, 7, 202107, "2021-07")),
        ("trips_2020-13.parquet", (None, None, None, "trips_2020-13")),
        ("trips_2020-00.parquet", (None, None, None, "trips_2020-00")),
        ("12020-01.parquet", (2020, 1, 202001, "2020-01")),
        ("trips.v2.parquet", (None, None, None, "trips.v2")),
    ],
)
def test_period_of_a_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    year, month = times.period_from_name(F.col("n"))
    row = df.select(year, month, times.period_number(F.col("n")), times.period_label(F.col("n")))
    assert tuple(row.first()) == expected


def test_plausible_range_includes_its_ends(spark):
    edges = [1262304000000000 - 1, 1262304000000000, 1893456000000000, 1893456000000000 + 1]
    df = spark.createDataFrame([(v,) for v in edges], "v bigint")
    assert values(df.select(times.is_plausible(F.col("v")))) == [False, True, True, False]


def test_first_of_month_and_micros_round_trip(spark):
    df = spark.sql("select 2020 y, 2 m, timestamp_ntz'2020-02-03 04:05:06.7' t")
    row = df.select(
        times.first_of_month(F.col("y"), F.col("m")),
        times.from_micros(times.to_micros(F.col("t"))),
    ).first()
    assert row[0] == date(2020, 2, 1)
    assert row[1] == datetime(2020, 2, 3, 4, 5, 6, 700000)
