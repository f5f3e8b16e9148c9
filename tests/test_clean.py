from pyspark.sql import functions as F

from tripweave.operators import clean
from tripweave.schema import TRIP_SCHEMA


def trips(spark, *rows):
    schema = "id int, pickup string, dropoff string, pu bigint, do bigint"
    df = spark.createDataFrame(list(rows), schema)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup", "dropoff")})


def ids(df):
    return sorted(r.id for r in df.collect())


def test_rules(spark):
    ok, later, other = "2020-02-03 10:00:00", "2020-02-03 10:10:00", "2020-03-01 00:00:00"
    df = trips(
        spark,
        (1, ok, later, 1, 2),
        (2, ok, ok, 1, 2),
        (3, later, ok, 1, 2),
        (4, other, other, 1, 2),
        (5, ok, later, 264, 2),
        (6, ok, later, 1, 265),
        (7, ok, later, None, 2),
        (8, ok, later, None, None),
        (9, None, later, 1, 2),
        (10, ok, None, 1, 2),
        (11, ok, later, None, 264),
    )
    kept = clean.clean(df, "pickup", "dropoff", "pu", "do", F.lit(202002))
    assert ids(kept) == [1, 2, 7, 8]
    no_label = clean.clean(df, "pickup", "dropoff", "pu", "do", F.lit(None).cast("int"))
    assert ids(no_label) == [1, 2, 4, 7, 8]
    no_rule = clean.clean(df, "pickup", "dropoff", "pu", "do")
    assert ids(no_rule) == [1, 2, 4, 7, 8]
    summary = clean.kept_counts(df, clean.clean_rule("pickup", "dropoff", "pu", "do"), [])
    assert tuple(summary.first()) == (11, 5)


def test_conform_fills_renames_casts_and_drops(spark):
    df = spark.sql(
        "select cast(1.9 as double) passenger_count, double('nan') RatecodeID, 7 VendorID,"
        " '5' payment_type, 1.25D airport_fee, 3.0D cbd_congestion_fee,"
        " '2020-02-03 04:05:06' tpep_pickup_datetime, 1577934245000006L tpep_dropoff_datetime"
    )
    out = clean.conform(df)
    assert out.schema.simpleString() == TRIP_SCHEMA.simpleString()
    row = out.first()
    assert (row.passenger_count, row.RatecodeID, row.VendorID, row.payment_type) == (1, None, 7, 5)
    assert row.Airport_fee == 1.25
    assert row.DOLocationID is None and row.store_and_fwd_flag is None
    assert str(row.tpep_pickup_datetime) == "2020-02-03 04:05:06"
    assert str(row.tpep_dropoff_datetime) == "2020-01-02 03:04:05.000006"


def test_own_name_goes_before_an_alias():
    assert clean.source_column("Airport_fee", ["airport_fee", "Airport_fee"],
                               {"Airport_fee": ["airport_fee"]}) == "Airport_fee"
    assert clean.source_column("Airport_fee", ["airport_fee"],
                               {"Airport_fee": ["airport_fee"]}) == "airport_fee"
    assert clean.source_column("Airport_fee", ["x"], {}) is None


def test_negative_fraction_is_cut_toward_zero(spark):
    df = spark.sql("select -1.9D passenger_count, 1e30D payment_type")
    row = clean.conform(df).first()
    assert (row.passenger_count, row.payment_type) == (-1, None)
