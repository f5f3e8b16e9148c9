import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripweave.operators.identify import add_trip_id
from tripweave.operators.numbering import number_in_buckets, running_totals

PATHS = [10_000_000, 2, 0]


def trips(spark, rows):
    df = spark.createDataFrame(rows, "src_file string, src_row bigint, p string")
    return df.select("src_file", "src_row", F.col("p").cast("timestamp_ntz").alias("pickup"))


def id_map(df):
    return {(r.src_file, r.src_row): r.trip_id for r in df.collect()}


@pytest.mark.parametrize("bucket_rows", PATHS)
def test_ids_follow_pickup_then_file_order(spark, bucket_rows):
    df = trips(
        spark,
        [
            ("a", 0, "2020-02-03 09:00:00"),
            ("a", 1, "2020-02-03 08:00:00"),
            ("a", 2, "2020-02-03 08:00:00"),
            ("a", 3, "2020-02-04 00:00:00"),
            ("a", 4, None),
            ("b", 0, "2020-02-03 07:00:00"),
        ],
    )
    assert id_map(add_trip_id(df, "pickup", bucket_rows=bucket_rows)) == {
        ("a", 1): 200203000000001,
        ("a", 2): 200203000000002,
        ("a", 0): 200203000000003,
        ("a", 3): 200204000000001,
        ("a", 4): None,
        ("b", 0): 200203000000001,
    }


@pytest.mark.parametrize("bucket_rows", PATHS)
def test_too_many_trips_in_a_day(spark, bucket_rows):
    df = trips(spark, [("a", i, "2020-02-03 09:00:00") for i in range(3)])
    assert add_trip_id(df, "pickup", max_seq=3, bucket_rows=bucket_rows).count() == 3
    with pytest.raises(Exception, match="more trips in a day than 2"):
        add_trip_id(df, "pickup", max_seq=2, bucket_rows=bucket_rows).collect()


def test_guards(spark):
    df = trips(spark, [("a", 0, "2020-02-03 09:00:00")])
    with pytest.raises(ValueError, match="missing column"):
        add_trip_id(df, "nowhere")
    with pytest.raises(ValueError, match="already"):
        add_trip_id(df.withColumn("trip_id", F.lit(1)), "pickup")


def test_ids_are_unique_and_dense_with_one_hot_day(spark):
    chance = random.Random(7)
    rows = []
    for i in range(4000):
        hot = chance.random() < 0.4
        day = 5 if hot else chance.randint(1, 28)
        second = 0 if hot and chance.random() < 0.5 else chance.randint(0, 59)
        rows.append(("f", i, f"2020-02-{day:02d} 10:00:{second:02d}"))
    df = trips(spark, rows).repartition(7)
    windowed = id_map(add_trip_id(df, "pickup"))
    split = id_map(add_trip_id(df, "pickup", bucket_rows=500))
    assert windowed == split == id_map(add_trip_id(df, "pickup", bucket_rows=37))
    order = sorted((p, i) for _, i, p in rows)
    place, expected = {}, {}
    for p, i in order:
        place[p[:10]] = place.get(p[:10], 0) + 1
        expected["f", i] = int(p[2:4] + p[5:7] + p[8:10]) * 10**9 + place[p[:10]]
    assert split == expected
    per_day = {}
    for value in split.values():
        per_day.setdefault(value // 10**9, []).append(value % 10**9)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_day.values())


@pytest.mark.parametrize("bucket_rows", [0, 10**6])
def test_numbering_in_buckets_matches_a_window_with_null_keys(spark, bucket_rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("k"),
        (F.col("id") * 7919 % 3001).alias("v"),
    )
    window = Window.partitionBy("k").orderBy("v")
    expected = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    at = F.timestamp_micros("v").cast("timestamp_ntz")
    out = number_in_buckets(df, ["k"], F.floor(F.col("v") / 100), at, ["v"], "n", bucket_rows)
    assert out.columns == expected.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, expected.collect()))


def test_running_totals_cross_blocks(spark):
    rows = [(i, i * 2, 1) for i in [0, 1, 2, 9, 10, 11, 35]]
    df = spark.createDataFrame(rows, "id bigint, a bigint, b bigint")
    out = running_totals(df, "id", {"a": "sum_a", "b": "sum_b"}, block=10).orderBy("id").collect()
    total, expected = 0, []
    for n, (i, a, b) in enumerate(rows, 1):
        total += a
        expected.append((i, a, b, total, n))
    assert [tuple(r) for r in out] == expected
