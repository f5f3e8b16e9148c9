import json

import pytest
from pyspark.sql import functions as F

from tripweave.operators import events
from tripweave.schema import DROPOFF, PICKUP, STEP_US

SECOND = 1_000_000
START = 1_580_000_000 * SECOND


def timed(spark, durations_us):
    rows = [(i, START, START + d) for i, d in enumerate(durations_us)]
    return spark.createDataFrame(rows, "trip_id bigint, pickup_us bigint, dropoff_us bigint")


@pytest.mark.parametrize(
    "duration_us, ticks",
    [
        (0, 0),
        (30 * SECOND, 0),
        (30 * SECOND + 1, 1),
        (60 * SECOND, 1),
        (61 * SECOND, 2),
        (-60 * SECOND, 0),
    ],
)
def test_ticks_lie_strictly_before_dropoff(spark, duration_us, ticks):
    out = events.expand_events(timed(spark, [duration_us])).orderBy("event_seq").collect()
    kinds = [r.event for r in out]
    assert kinds == ["PICKUP"] + ["IN_TRANSIT"] * ticks + ["DROPOFF"]
    times = [r.event_time_us - START for r in out]
    assert times == [0] + [30 * SECOND * k for k in range(1, ticks + 1)] + [duration_us]


CHUNK = 64


@pytest.mark.parametrize("long_trip", [None, 0, 2, 10_000])
def test_a_long_trip_unfolds_over_many_chunks(spark, long_trip):
    n = 3 * CHUNK + 17
    trips = timed(spark, [n * STEP_US + 1, SECOND])
    out = events.expand_events(trips, long_trip=long_trip, chunk=CHUNK)
    assert out.where("trip_id = 0").count() == n + 2
    seqs = out.where("trip_id = 0").agg(
        F.min("event_seq"), F.max("event_seq"), F.countDistinct("event_seq")
    )
    assert tuple(seqs.first()) == (0, n + 1, n + 2)
    assert out.where("trip_id = 1").count() == 2


@pytest.mark.parametrize("extra", [-2, -1, 0, 1, 2])
def test_chunk_edges(spark, extra):
    n = CHUNK + extra
    out = events.expand_events(timed(spark, [n * STEP_US + 1]), chunk=CHUNK)
    row = out.agg(F.count("*"), F.countDistinct("event_time_us"), F.max("event_seq")).first()
    assert tuple(row) == (n + 2, n + 2, n + 1)


def test_times_further_apart_than_can_be_counted(spark):
    rows = [(1, -(2**63), 2**63 - 1)]
    trips = spark.createDataFrame(rows, "trip_id bigint, pickup_us bigint, dropoff_us bigint")
    out = events.replay_schedule(events.expand_events(trips), -(2**63), 5.0).collect()
    assert [(r.event, r.replay_offset_us) for r in out] == [("PICKUP", 0), ("DROPOFF", None)]


def test_counts_match_the_unfolded_events(spark):
    trips = timed(spark, [d * 7 * SECOND for d in range(-5, 60)])
    unfolded = events.expand_events(trips).groupBy("event").count().collect()
    expected = {r["event"]: r["count"] for r in unfolded}
    expected["sent"] = sum(expected.values())
    got = {r.event: r.n_events for r in events.event_counts(trips).collect()}
    assert got == expected
    none = {r.event: r.n_events for r in events.event_counts(trips.limit(0)).collect()}
    assert set(none.values()) == {0}


def test_time_order_and_first_event(spark):
    trips = timed(spark, [-90 * SECOND, 61 * SECOND, 0])
    timeline = events.in_time_order(events.expand_events(trips)).collect()
    order = [(r.event_time_us, r.trip_id, r.event_seq) for r in timeline]
    assert order == sorted(order)
    row = events.first_event(trips).first()
    assert row.first_event_us == START - 90 * SECOND
    assert row.first_event_iso == "2020-01-26T00:51:50.000000Z"


def test_replay_schedule(spark):
    timeline = events.expand_events(timed(spark, [61 * SECOND]))
    out = events.replay_schedule(timeline, START, 5.0, slice_us=5 * SECOND).orderBy("event_seq")
    got = [(r.replay_offset_us, r.replay_slice) for r in out.collect()]
    assert got == [(0, 0), (6 * SECOND, 1), (12 * SECOND, 2), (12_200_000, 2)]


def raw_trip(spark, **changes):
    values = {
        "trip_id": "200203000000001L", PICKUP: "timestamp_ntz'2020-02-03 04:05:06'",
        DROPOFF: "timestamp_ntz'2020-02-03 04:06:07'", "PULocationID": "1L",
        "DOLocationID": "2L", "VendorID": "2L", "fare_amount": "12.5D",
        "trip_distance": "1.23456789D",
    }
    values.update(changes)
    return spark.sql("select " + ", ".join(f"{v} {k}" for k, v in values.items()))


def test_defaults_replace_nulls_and_missing_columns(spark):
    trip = raw_trip(spark, fare_amount="cast(null as double)", PULocationID="cast(null as int)",
                    trip_id="cast(null as bigint)", passenger_count="'2'",
                    RatecodeID="-1.9D", payment_type="7S", VendorID="double('nan')",
                    DOLocationID="date'1970-01-02'", extra="2", mta_tax="'1.5'",
                    tip_amount="1.25BD", store_and_fwd_flag="5",
                    **{PICKUP: "cast(null as timestamp_ntz)"})
    row = events.with_defaults(trip).first()
    assert row.trip_id == 0 and row.fare_amount == 0.0 and row.PULocationID == 0
    assert row.store_and_fwd_flag == "" and row.mta_tax == 0.0 and row.pickup_us == 0
    assert (row.passenger_count, row.RatecodeID, row.payment_type, row.VendorID) == (0, -1, 7, 0)
    assert (row.DOLocationID, row.extra, row.tip_amount) == (86_400_000_000, 2.0, 1.25)
    assert row.tolls_amount == 0.0
    assert row.dropoff_us == 1_580_702_767 * SECOND


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns: trip_id"):
        events.with_defaults(raw_trip(spark).drop("trip_id"))


def located(spark):
    return events.wire_amounts(events.with_defaults(raw_trip(spark))).withColumns(
        {"pu_lat": F.lit(40.0), "pu_lon": F.lit(-74.0),
         "do_lat": F.lit(41.0), "do_lon": F.lit(-73.0)}
    )


def test_payloads_hold_the_fields_of_their_kind(spark):
    timeline = events.with_positions(events.expand_events(located(spark)))
    rows = events.event_payload(timeline, keep=("event_seq",)).orderBy("event_seq").collect()
    assert {r.key for r in rows} == {"200203000000001"}
    pickup, step, _, dropoff = [json.loads(r.value) for r in rows]
    assert list(pickup) == events.PICKUP_FIELDS
    assert list(step) == events.IN_TRANSIT_FIELDS
    assert list(dropoff) == events.DROPOFF_FIELDS
    assert pickup["ts"] == "2020-02-03T04:05:06.000000Z"
    assert (pickup["lat"], pickup["lon"], pickup["VendorID"]) == (40.0, -74.0, 2)
    assert step["lat"] == round(40 + 30 / 61, 6) and step["lon"] == round(-74 + 30 / 61, 6)
    assert (dropoff["lat"], dropoff["trip_distance"], dropoff["extra"]) == (41.0, 1.234568, 0.0)
    assert dropoff["ts"] == "2020-02-03T04:06:07.000000Z"


def test_every_event_lies_on_its_trip(spark):
    trips = timed(spark, [d * 11 * SECOND for d in range(50)]).withColumns(
        {"pu_lat": F.lit(40.0), "pu_lon": F.lit(-74.0),
         "do_lat": F.lit(41.0), "do_lon": F.lit(-73.0)}
    )
    out = events.with_positions(events.expand_events(trips))
    off = out.where(
        ~F.col("event_time_us").between(F.col("pickup_us"), F.col("dropoff_us"))
        | ~F.col("lat").between(40, 41)
        | ~F.col("lon").between(-74, -73)
    )
    assert off.count() == 0


def test_timestamp_sample_and_check(spark):
    rows = [("a", 0, 0), ("a", 1, None), ("a", 2, 1_600_000_000), ("a", 3, 5),
            ("b", 0, 0), ("b", 1, 0), ("c", 0, 7)]
    df = spark.createDataFrame(rows, "file string, row bigint, v bigint")
    out = {r.file: r for r in events.timestamp_sample(df, "v", ["file"], ["row"]).collect()}
    assert (out["a"].raw, out["a"].iso, out["a"].in_range) == (
        1_600_000_000, "2020-09-13T12:26:40Z", True)
    assert (out["b"].raw, out["b"].iso, out["b"].in_range) == (0, "n/a", False)
    assert (out["c"].normalized_us, out["c"].in_range) == (7 * SECOND, False)
    check = {r.file: tuple(r)[1:] for r in events.timestamp_check(df, "v", ["file"]).collect()}
    assert check == {"a": (4, 1, 3), "b": (2, 0, 2), "c": (1, 0, 1)}
