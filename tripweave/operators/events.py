"""Trips to a timeline of PICKUP, IN_TRANSIT and DROPOFF events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.geo import interpolate
from tripweave.functions.numbers import fixed_decimals
from tripweave.functions.text import message_key
from tripweave.functions.times import (
    epoch_micros,
    is_plausible,
    iso_seconds,
    iso_utc,
    normalize_epoch_us,
    whole_div,
)
from tripweave.schema import DROPOFF, PICKUP, STEP_US, TRIP_ID, TRIP_SCHEMA

# Events that one row unfolds into at a time; keeps a trip of years out of memory.
CHUNK = 65_536

# A trip with more events than this is unfolded by many tasks.
LONG_TRIP = 10_000_000

# The fields of each event kind on the wire, in order.
PICKUP_FIELDS = [
    "event", "trip_id", "PULocationID", "lat", "lon", "VendorID", "passenger_count", "ts",
]
IN_TRANSIT_FIELDS = ["event", "trip_id", "lat", "lon", "ts"]
DROPOFF_FIELDS = [
    "event", "trip_id", "DOLocationID", "lat", "lon", "fare_amount", "total_amount",
    "trip_distance", "RatecodeID", "payment_type", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "Airport_fee", "ts",
]


AMOUNTS = [f.name for f in TRIP_SCHEMA.fields if f.dataType.simpleString() == "double"]


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
TIME_TYPES = ("date", "timestamp", "timestamp_ntz")


def value_or_default(column: Column, stored: str, kind: str) -> Column:
    """A column as `kind`, or 0, 0.0 or "" where it is null or of an unrelated type.

    Fractions are cut off, and a time read as a whole number counts microseconds.
    Text is not read as a number.
    """
    default = F.lit({"string": "", "double": 0.0}.get(kind, 0)).cast(kind)
    numeric = stored in NUMBER_TYPES or stored.startswith("decimal")
    if kind == "string":
        value = column if stored == "string" else default
    elif kind == "bigint" and stored in TIME_TYPES:
        value = epoch_micros(column, stored)
    else:
        value = column.try_cast(kind) if numeric else default
    return F.coalesce(value, default)


def with_defaults(
    trips: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed trips with nothing null: absent or unreadable values become 0, 0.0 or "".

    Times become `pickup_us` and `dropoff_us`, microseconds since 1970. `keep`
    names columns to carry along as they are.
    """
    require_columns(trips, pickup, dropoff, TRIP_ID)
    stored = dict(trips.dtypes)
    kinds = {f.name: f.dataType.simpleString() for f in TRIP_SCHEMA.fields}
    kinds = {TRIP_ID: "bigint"} | {n: k for n, k in kinds.items() if n not in (PICKUP, DROPOFF)}
    columns = []
    for name, kind in kinds.items():
        column = F.col(name) if name in stored else F.lit(None)
        columns.append(value_or_default(column, stored.get(name, "void"), kind).alias(name))
    for name, source in (("pickup_us", pickup), ("dropoff_us", dropoff)):
        micros = epoch_micros(F.col(source), stored[source])
        columns.append(F.coalesce(micros, F.lit(0).cast("bigint")).alias(name))
    return trips.select(*columns, *keep)


def tick_count(pickup_us: Column, dropoff_us: Column, step_us: int = STEP_US) -> Column:
    """How many steps after pickup lie strictly before drop-off.

    0 for times so wrong that they lie further apart than can be counted; see
    `uncountable`.
    """
    duration = F.try_subtract(dropoff_us, pickup_us)
    return F.when(duration > 0, whole_div(duration - 1, step_us)).otherwise(0)


def uncountable(pickup_us: Column, dropoff_us: Column) -> Column:
    """The times lie further apart than a 64-bit number of microseconds can say."""
    return (dropoff_us > pickup_us) & F.try_subtract(dropoff_us, pickup_us).isNull()


def trip_statistics(trips: DataFrame, step_us: int = STEP_US) -> DataFrame:
    """One row, from one narrow pass: most_ticks, first_event_us, n_uncountable."""
    pickup_us, dropoff_us = F.col("pickup_us"), F.col("dropoff_us")
    return trips.agg(
        F.coalesce(F.max(tick_count(pickup_us, dropoff_us, step_us)), F.lit(0)).alias("most_ticks"),
        F.min(F.least(pickup_us, dropoff_us)).alias("first_event_us"),
        F.count_if(uncountable(pickup_us, dropoff_us)).alias("n_uncountable"),
    )


def event_times(seq: Column, final: Column, step_us: int, pickup_us: str, dropoff_us: str) -> Column:
    """Time of the event at a position in its trip; `final` is the drop-off's."""
    return F.when(seq == final, F.col(dropoff_us)).otherwise(F.col(pickup_us) + seq * step_us)


def read_statistics(trips: DataFrame, source: str, step_us: int = STEP_US) -> DataFrame:
    """A row per source: path, n_read and what `trip_statistics` has; reads every column of `trips`."""
    pickup_us, dropoff_us = F.col("pickup_us"), F.col("dropoff_us")
    return trips.groupBy(F.col(source).alias("path")).agg(
        F.count("*").alias("n_read"),
        F.max(tick_count(pickup_us, dropoff_us, step_us)).alias("most_ticks"),
        F.min(F.least(pickup_us, dropoff_us)).alias("first_event_us"),
        F.count_if(uncountable(pickup_us, dropoff_us)).alias("n_uncountable"),
        F.bit_xor(F.xxhash64(*[name for name in trips.columns if name != source])).alias("seen"),
    )


def expand_events(
    trips: DataFrame,
    step_us: int = STEP_US,
    pickup_us: str = "pickup_us",
    dropoff_us: str = "dropoff_us",
    long_trip: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per event, with `event`, `event_time_us` and `event_seq` added.

    `event_seq` is 0 for the pickup, 1..n for the steps and n + 1 for the drop-off.
    A trip unfolds where it is, without a shuffle. With `long_trip`, trips of
    more steps are cut into chunks that go to different tasks, at the price of
    reading the trips twice.
    """
    seq, final, start = F.col("event_seq"), F.col("_final"), F.col("_chunk") * chunk

    def in_chunks(counted: DataFrame) -> DataFrame:
        numbers = F.sequence(F.lit(0).cast("bigint"), whole_div(final, chunk))
        return counted.withColumn("_chunk", F.explode(numbers))

    def unfold(chunked: DataFrame) -> DataFrame:
        numbers = F.sequence(start, F.least(start + (chunk - 1), final))
        kind = F.when(seq == 0, "PICKUP").when(seq == final, "DROPOFF").otherwise("IN_TRANSIT")
        time = event_times(seq, final, step_us, pickup_us, dropoff_us)
        events = chunked.withColumn("event_seq", F.explode(numbers))
        return events.withColumns({"event": kind, "event_time_us": time}).drop("_final", "_chunk")

    ticks = tick_count(F.col(pickup_us), F.col(dropoff_us), step_us)
    counted = trips.withColumn("_final", ticks + 1)
    if long_trip is None:
        return unfold(in_chunks(counted))
    usual = unfold(in_chunks(counted.where(final <= long_trip + 1)))
    spread_out = in_chunks(counted.where(final > long_trip + 1)).repartition(
        "_chunk", pickup_us, dropoff_us
    )
    return usual.unionByName(unfold(spread_out))


def with_positions(events: DataFrame) -> DataFrame:
    """Add `lat` and `lon` to events that carry `pu_` and `do_` coordinates."""

    def at(start: str, end: str) -> Column:
        moving = interpolate(
            F.col(start),
            F.col(end),
            F.col("pickup_us"),
            F.col("dropoff_us"),
            F.col("event_time_us"),
        )
        return (
            F.when(F.col("event") == "PICKUP", F.col(start))
            .when(F.col("event") == "DROPOFF", F.col(end))
            .otherwise(moving)
        )

    return events.withColumns({"lat": at("pu_lat", "do_lat"), "lon": at("pu_lon", "do_lon")})


def in_time_order(events: DataFrame) -> DataFrame:
    """Global event-time order of unfolded events; ties by trip, then by position in the trip.

    Moves every event: from trips, `events_in_time_order` does not.
    """
    return events.orderBy("event_time_us", TRIP_ID, "event_seq")


def event_counts(
    trips: DataFrame,
    step_us: int = STEP_US,
    pickup_us: str = "pickup_us",
    dropoff_us: str = "dropoff_us",
) -> DataFrame:
    """Events of each kind and, as `sent`, of all kinds; counted without unfolding the trips."""
    ticks = tick_count(F.col(pickup_us), F.col(dropoff_us), step_us)
    totals = trips.agg(
        F.count("*").alias("n_trips"), F.coalesce(F.sum(ticks), F.lit(0)).alias("n_ticks")
    )
    trips_seen, steps = F.col("n_trips"), F.col("n_ticks")
    kinds = {
        "PICKUP": trips_seen,
        "IN_TRANSIT": steps,
        "DROPOFF": trips_seen,
        "sent": trips_seen * 2 + steps,
    }
    rows = [F.struct(F.lit(k).alias("event"), n.alias("n_events")) for k, n in kinds.items()]
    return totals.select(F.inline(F.array(*rows)))


def first_event(trips: DataFrame) -> DataFrame:
    """The earliest event time, found on the trips without unfolding them."""
    earliest = F.min(F.least("pickup_us", "dropoff_us"))
    return trips.agg(earliest.alias("first_event_us")).withColumn(
        "first_event_iso", iso_utc(F.col("first_event_us"))
    )


def replay_schedule(
    events: DataFrame, start_us: Column | int, speed: float, slice_us: int | None = None
) -> DataFrame:
    """Add `replay_offset_us`: wall-clock time after the start at which an event is due.

    With `slice_us` also `replay_slice`, the number of the interval it falls into.
    """
    offset = F.try_subtract(F.col("event_time_us"), F.lit(start_us)) / F.lit(float(speed))
    scheduled = events.withColumn("replay_offset_us", F.floor(offset))
    if slice_us is None:
        return scheduled
    return scheduled.withColumn("replay_slice", whole_div(F.col("replay_offset_us"), slice_us))


def wire_amounts(trips: DataFrame) -> DataFrame:
    """Trips with their amounts rounded for the wire; once per trip, not once per event.

    Rounds them as a list: ten separate expressions would outgrow the size up to
    which the code around them is compiled.
    """
    rounded = trips.withColumn("_amounts", F.transform(F.array(*AMOUNTS), fixed_decimals))
    amounts = {name: F.get("_amounts", F.lit(i)) for i, name in enumerate(AMOUNTS)}
    return rounded.withColumns(amounts).drop("_amounts")


def event_payload(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as keyed JSON text (key, value), with the fields of their kind.

    Amounts are written as they are; `wire_amounts` rounds them on the trips.
    """

    def body(fields: list[str]) -> Column:
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    value = (
        F.when(F.col("event") == "PICKUP", body(PICKUP_FIELDS))
        .when(F.col("event") == "IN_TRANSIT", body(IN_TRANSIT_FIELDS))
        .otherwise(body(DROPOFF_FIELDS))
    )
    written = events.withColumns(
        {
            "lat": fixed_decimals(F.col("lat")),
            "lon": fixed_decimals(F.col("lon")),
            "ts": iso_utc(F.col("event_time_us")),
        }
    )
    return written.select(*keep, message_key(F.col(TRIP_ID)).alias("key"), value.alias("value"))


def timestamp_sample(df: DataFrame, column: str, by: list[str], order: list[str]) -> DataFrame:
    """The first non-zero epoch of each source along `order`, else its first value.

    Uses combining aggregates, so a large source is never sorted or gathered.
    """
    value = F.coalesce(F.col(column), F.lit(0))
    position = F.struct(*order)
    sample = df.groupBy(*by).agg(
        F.coalesce(
            F.min_by(value, F.when(value != 0, position)), F.min_by(value, position)
        ).alias("raw")
    )
    return sample.withColumn("normalized_us", normalize_epoch_us(F.col("raw"))).withColumns(
        {
            "iso": iso_seconds(F.col("normalized_us")),
            "in_range": is_plausible(F.col("normalized_us")),
        }
    )


def timestamp_check(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """How many epochs of each source are plausible once scaled to microseconds."""
    fine = is_plausible(normalize_epoch_us(F.coalesce(F.col(column), F.lit(0))))
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(fine).alias("n_in_range"),
        F.count_if(~fine).alias("n_out_of_range"),
    )
