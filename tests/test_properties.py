"""Random inputs against plain Python statements of the rules."""

import json
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.functions.times import from_micros, normalize_epoch_us
from tripweave.operators import events
from tripweave.operators.medians import exact_medians
from tripweave.operators.numbering import number_in_buckets
from tripweave.streaming import feed

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def cut(value, divisor):
    return -(-value // divisor) if value < 0 else value // divisor


def epoch_rule(value):
    size = abs(value)
    if 1262304000000000 <= size <= 1893456000000000:
        return value
    if size < 10**11:
        return value * 10**6
    if size < 10**14:
        return value * 1000
    return value if size < 10**17 else cut(value, 1000)


magnitudes = st.integers(0, 62).flatmap(lambda bits: st.integers(-(2**bits), 2**bits))


@few
@given(st.lists(magnitudes, min_size=1, max_size=200))
def test_epochs(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.select(normalize_epoch_us(F.col("v"))).collect()]
    assert got == [epoch_rule(v) for v in values]


@few
@given(st.lists(st.integers(-100, 2000), min_size=1, max_size=50), st.integers(1, 70))
def test_ticks(spark, durations, step):
    rows = [(i, 5, 5 + d) for i, d in enumerate(durations)]
    trips = spark.createDataFrame(rows, "trip_id bigint, pickup_us bigint, dropoff_us bigint")
    out = events.expand_events(trips, step, chunk=16, long_trip=40).collect()
    got = sorted((r.trip_id, r.event_seq, r.event, r.event_time_us) for r in out)
    expected = []
    for i, start, end in rows:
        times = list(range(start + step, end, step))
        kinds = ["PICKUP"] + ["IN_TRANSIT"] * len(times) + ["DROPOFF"]
        expected += [(i, n, k, t) for n, (k, t) in enumerate(zip(kinds, [start, *times, end]))]
    assert got == expected


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=300), st.sampled_from([0, 3, 10**6]))
def test_positions(spark, pairs, bucket_rows):
    rows = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, i bigint").withColumn("at", from_micros(F.col("v")))
    coarse = F.floor(F.col("v") / 2)
    out = number_in_buckets(df, ["k"], coarse, F.col("at"), ["i"], "n", bucket_rows).drop("at")
    expected = []
    for key in {k for k, _, _ in rows}:
        group = sorted((v, i) for k, v, i in rows if k == key)
        expected += [(key, v, i, n) for n, (v, i) in enumerate(group, 1)]
    assert sorted(map(tuple, out.collect())) == sorted(expected)


floats = st.one_of(st.none(), st.floats(-1e3, 1e3), st.sampled_from([0.0, -0.0, 1.5, 1e308, -1e308]), st.floats(0, 1e-9))


@few
@given(
    st.lists(st.tuples(st.sampled_from([None, 1, 2]), floats, floats), max_size=80),
    st.sampled_from([(1 / 1024, 65536), (1e6, 4), (1e9, 2)]),
    st.booleans(),
)
def test_medians(spark, rows, sizes, small):
    df = spark.createDataFrame(rows, "k bigint, a double, b double")
    got = exact_medians(df, ["k"], {"a": "mid_a", "b": "mid_b"}, small, *sizes).collect()
    groups = {}
    for k, *values in rows:
        for i, value in enumerate(values):
            if value is not None:
                groups.setdefault(k, ([], []))[i].append(value)
    expected = {k: tuple(statistics.median(own) if own else None for own in lists) for k, lists in groups.items()}
    assert {r.k: (r.mid_a, r.mid_b) for r in got} == expected and len(got) == len(expected)


numbers = st.one_of(
    st.none(), st.integers(-(10**12), 10**12), st.floats(-1e6, 1e6).map(lambda x: round(x, 3))
)
ids = st.one_of(numbers, numbers.map(str), st.sampled_from(["", "x", "1.9", True, [1], {"a": 1}]))


def id_rule(value):
    """(the id, whether it can be read)."""
    if value is None or value == "":
        return None, True
    if isinstance(value, bool | list | dict):
        return None, False
    try:
        return int(float(value)), True
    except ValueError:
        return None, False


@few
@given(st.lists(ids, min_size=1, max_size=60))
def test_messages(spark, values):
    texts = [json.dumps({"event": "PICKUP", "trip_id": v, "other": 1}) for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = feed.decode_events(df).collect()
    assert [r.value for r in rows] == texts
    assert [(r.trip_id, r.problem is None) for r in rows] == [id_rule(v) for v in values]
