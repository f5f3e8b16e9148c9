"""Trips, zones, outlines and messages drawn from the shared test tables.

Each function takes (spark, sf_dir) and maps a table onto the columns the
operators work on; the SQL beside the queries states the same mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.times import to_micros
from tripweave.session import apply_settings, spread

SENTINELS = [23, 24]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each order, some with a month that does not exist and some without any.

    A price below 50,000 stands for a file without bytes.
    """
    orders = table(spark, sf_dir, "orders")
    month = F.lpad((F.col("o_custkey") % 16).cast("string"), 2, "0")
    name = F.concat(
        F.lit("trips_"), F.year("o_orderdate").cast("string"), F.lit("-"), month, F.lit(".parquet")
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    plain = F.concat(F.lit("order_"), F.col("o_orderkey"), F.lit(".parquet"))
    name = F.when(urgent, plain).otherwise(name)
    length = F.when(F.col("o_totalprice") < 50_000, 0).otherwise(1)
    return orders.select("o_orderkey", name.alias("path"), length.alias("length"))


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip per order line: ordered = picked up, shipped = dropped off."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    label = F.concat(F.lit("trips_"), F.date_format("l_shipdate", "yyyy-MM"), F.lit(".parquet"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        F.col("o_orderdate").alias("pickup"),
        F.col("l_shipdate").alias("dropoff"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).cast("bigint").alias("pu"),
        F.col("s_nationkey").cast("bigint").alias("do"),
        label.alias("name"),
    )


def spread_events(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Rows of the events table, also as a stream, dealt by their number, which the footers say."""
    return spread(events, "event_id", rows=table(spark, sf_dir, "events").count())


def event_k(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip per event; `value` says how long it takes, at a tenth of a second per hundredth.

    Values below 20 give a drop-off before the pickup, 20 itself one of no length.
    """
    duration = "ts + (cast(round(value * 100) as bigint) - 2000) * interval '0.1' second"
    events = spread_events(spark, sf_dir, table(spark, sf_dir, "events"))
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.col("user_id").alias("VendorID"),
        event_k().alias("PULocationID"),
        (event_k() % 25).alias("DOLocationID"),
        F.length("event_type").cast("bigint").alias("passenger_count"),
        F.col("value").alias("fare_amount"),
        (F.col("value") + 2.5).alias("total_amount"),
        F.nullif(F.col("value") / 4, F.lit(12.5)).alias("trip_distance"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr(duration).alias("tpep_dropoff_datetime"),
    )


def zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of a zone file per customer, well or badly written by market segment."""
    customers = table(spark, sf_dir, "customer")
    zone, account = F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string")
    number, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    line = (
        F.when(segment == "BUILDING", F.concat_ws(",", zone, account))
        .when(segment == "MACHINERY", F.concat_ws(",", zone, F.lit("east"), number))
        .when(segment == "FURNITURE", F.concat(F.lit('"'), zone, F.lit('", '), account,
                                               F.lit(' ,"'), number, F.lit('.5x"')))
        .otherwise(F.concat_ws(",", zone, account, number, segment))
    )
    return customers.select("c_custkey", line.alias("value"))


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coordinate per nation; event keys above 24 find none."""
    nation = table(spark, sf_dir, "nation")
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    return nation.select(
        key.cast("bigint").alias("LocationID"),
        (key * 0.025 - 74.3).alias("longitude"),
        (region * 0.1 + key * 0.01 + 40.5).alias("latitude"),
    )


def embedding_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several coordinates per label, in the order of `vec_id`."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("LocationID"),
        F.get("embedding", F.lit(0)).cast("double").alias("longitude"),
        F.get("embedding", F.lit(1)).cast("double").alias("latitude"),
        "vec_id",
    )


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of an embedding taken in pairs as points of an outline, in feet."""
    pairs = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        "embedding",
        F.explode(F.sequence(F.lit(0), F.expr("size(embedding) div 2 - 1").cast("int"))).alias("point"),
    )
    x = F.get("embedding", F.col("point") * 2).cast("double")
    y = F.get("embedding", F.col("point") * 2 + 1).cast("double")
    return pairs.select(
        F.col("vec_id").alias("shape_seq"),
        F.col("label").cast("string").alias("location_id"),
        F.col("point").cast("bigint").alias("point"),
        (x * 200000.0 + 984250.0).alias("x"),
        (y * 200000.0 + 200000.0).alias("y"),
    )


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as integers whose unit depends on the kind of event.

    Times go back one year per `k`, so that some leave the plausible range, and
    are zero where the clock failed, that is for values below 10.
    """
    us = to_micros(F.col("ts")) - event_k() * 31_536_000_000_000
    kind = F.col("event_type")
    raw = (
        F.when(F.col("value") < 10, F.lit(0))
        .when(kind == "view", F.call_function("div", us, F.lit(1_000_000)))
        .when(kind == "click", F.call_function("div", us, F.lit(1_000)))
        .when(kind == "purchase", us)
        .otherwise(us * 1_000)
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", raw.alias("raw"))


# The fields of a message beside those that some messages have wrong.
WHOLE_FIELDS = ["DOLocationID", "VendorID", "passenger_count", "RatecodeID", "payment_type"]
DECIMAL_FIELDS = [
    "lat", "lon", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "Airport_fee", "total_amount", "trip_distance",
]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(spread_events(spark, sf_dir, table(spark, sf_dir, "events")))


def as_messages(events: DataFrame) -> DataFrame:
    """A JSON message per event with all fields, some broken, empty or with a value of the wrong type.

    The n-th other whole number is n more than `k`, the n-th decimal n with `k` behind the point.
    """
    k = event_k()
    number = F.col("event_id").cast("string")
    trip = (
        F.when(k == 13, F.lit("null"))
        .when(k == 17, F.concat(F.lit('"'), number, F.lit('"')))
        .when(k == 19, F.lit('"none"'))
        .when(k == 23, F.concat(number, F.lit(".9")))
        .otherwise(number)
    )
    others = [F.concat(F.lit(f', "{n}": '), (k + i).cast("string")) for i, n in enumerate(WHOLE_FIELDS)]
    others += [F.concat(F.lit(f', "{n}": {i}.'), k.cast("string")) for i, n in enumerate(DECIMAL_FIELDS)]
    text = F.concat(
        F.lit('{"ts": "t'), k.cast("string"), F.lit('"'), *others,
        F.lit(', "event": "'), F.col("event_type"),
        F.lit('", "trip_id": '), trip,
        F.lit(', "PULocationID": '), k.cast("string"),
        F.lit(', "unused": [1], "fare_amount": '), F.col("value").cast("string"),
        F.when(F.col("value") < 1, F.lit("")).otherwise("}"),
    )
    value = F.when(k == 29, F.lit("")).otherwise(text)
    return events.select("event_id", F.col("ts").alias("sent_at"), value.alias("value"))
