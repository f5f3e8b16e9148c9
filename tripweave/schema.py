"""Column names, types and constants of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PICKUP_ZONE = "PULocationID"
DROPOFF_ZONE = "DOLocationID"
TRIP_ID = "trip_id"

# Where a row came from; kept beside the canonical columns because later ties
# follow the order of the rows in their file.
SOURCE_FILE = "src_file"
SOURCE_ROW = "src_row"

# Canonical trip columns, in order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("VendorID", T.LongType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)

# Other spellings of a canonical column, used when the canonical one is absent.
TRIP_ALIASES = {"Airport_fee": ["airport_fee"]}

# Wire event, in order. `ts` is text.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("trip_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("VendorID", T.LongType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
    ]
)

# Zones that mean "unknown" and "outside the city".
SENTINEL_ZONES = [264, 265]

# Coordinates for a zone that has none: longitude, latitude.
DEFAULT_LONGITUDE = -73.9855
DEFAULT_LATITUDE = 40.7580

# Zones used when a coordinate file holds no usable row: id, longitude, latitude.
FALLBACK_ZONES = [
    (142, -73.9841, 40.7711),
    (230, -73.9860, 40.7629),
    (100, -73.9934, 40.7505),
    (161, -73.9864, 40.7559),
]

# Trip ids are yymmdd * MAX_SEQUENCE + position within the day.
MAX_SEQUENCE = 1_000_000_000

# Spacing of in-transit events.
STEP_US = 30_000_000

# 2010-01-01 and 2030-01-01: the range in which a time is plausible.
PLAUSIBLE_FROM_US = 1262304000000000
PLAUSIBLE_TO_US = 1893456000000000

# Years the cleaned collection covers, as inclusive (year, month) bounds.
CLEAN_START = (2011, 1)
CLEAN_END = (2025, 12)

# Lambert conformal conic with two parallels, in US survey feet.
STATE_PLANE = {
    "semi_major": 6378137.0,
    "inverse_flattening": 298.257222101,
    "false_easting": 984250.0,
    "false_northing": 0.0,
    "central_meridian": -74.0,
    "parallel_1": 40.66666666666666,
    "parallel_2": 41.03333333333333,
    "origin_latitude": 40.16666666666666,
    "unit_metres": 0.3048006096012192,
}
