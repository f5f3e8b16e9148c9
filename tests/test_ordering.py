"""Events in time order by moving trips: against sorting all events, and in the plan."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tripweave.operators import events
from tripweave.operators.ordering import events_in_time_order, slice_pieces

SCHEMA = "trip_id bigint, pickup_us bigint, dropoff_us bigint"
COLUMNS = ["trip_id", "event_seq", "event", "event_time_us"]


def both(spark, rows, **options):
    trips = spark.createDataFrame(rows, SCHEMA).repartition(3)
    step = options.get("step_us", 10)
    plain = [tuple(r) for r in events.expand_events(trips, step).select(*COLUMNS).collect()]
    got = [tuple(r) for r in events_in_time_order(trips, **{"step_us": step, **options}).select(*COLUMNS).collect()]
    return got, sorted(plain, key=lambda r: (r[3], r[0], r[1]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(-2000, 2000), st.integers(-2000, 2000)), max_size=12),
    st.sampled_from([10, 37, 640]),
    st.sampled_from([1, 5, 1000]),
)
def test_order_is_that_of_sorted_events(spark, rows, width, most):
    got, expected = both(spark, rows, width=width, slice_events=most, chunk=3)
    assert got == expected


def test_one_instant_with_most_events_is_spread(spark):
    rows = [(i % 50, 0, 0) for i in range(2000)] + [(i, i * 5, i * 9) for i in range(300)]
    got, expected = both(spark, rows, slice_events=100)
    assert got == expected
    trips = spark.createDataFrame(rows, SCHEMA)
    ordered = events_in_time_order(trips, 10, slice_events=100)
    sizes = [len(part) for part in ordered.select("trip_id").rdd.glom().collect()]
    assert max(sizes) < 0.6 * sum(sizes)


@pytest.mark.parametrize("times", [(-(2**63), 2**63 - 1), (2**63 - 1, -(2**63)), (2**63 - 5, 2**63 - 1), (-(2**63), -(2**63) + 25)])
def test_times_at_the_ends_of_what_can_be_counted(spark, times):
    got, expected = both(spark, [(1, *times), (2, 0, 35)])
    assert got == expected


def test_pieces_hold_each_event_once(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(-10**4, 10**4), rng.randint(-10**4, 10**4)) for i in range(200)]
    trips = spark.createDataFrame(rows, SCHEMA)
    pieces = slice_pieces(trips, 10, 700).collect()
    held = sorted((r.trip_id, seq) for r in pieces for seq in range(r._from, r._to + 1))
    assert held == sorted((r.trip_id, r.event_seq) for r in events.expand_events(trips, 10).collect())


def test_a_slice_narrower_than_a_step_is_refused(spark):
    with pytest.raises(ValueError):
        events_in_time_order(spark.createDataFrame([], SCHEMA), 10, width=9)
    assert events_in_time_order(spark.createDataFrame([], SCHEMA)).collect() == []


def test_trips_move_and_events_do_not(spark):
    trips = spark.createDataFrame([(i, i * 1000, i * 1000 + 50_000) for i in range(100)], SCHEMA)
    ordered = events_in_time_order(trips, 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ordered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    moved = plan[re.search(r"Exchange rangepartitioning", plan).start() :]
    assert "event_seq" not in moved and "event_time_us" not in moved
    assert plan.count("Exchange") == 1
