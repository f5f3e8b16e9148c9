"""The shape of physical plans: what is read, what is shuffled, what gets compiled."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tripweave.functions.geo import LATITUDE_STEPS
from tripweave.operators import clean, counts, events, zones
from tripweave.plans import queries
from tripweave.plans import standins as st
from tripweave.schema import PICKUP
from tripweave.sources.files import list_files, read_footers
from tripweave.sources.trips import read_trips
from tripweave.streaming import feed

SF_DIR = "/root/testdata/sf0.001"

# The JVM leaves longer methods uncompiled.
COMPILED_BYTES = 8000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", plan(df)))


def method_sizes(spark, df):
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    stages = getattr(debug, "package").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())]


@pytest.fixture
def fixed_plans(spark):
    """Plans as they are run, without the adaptive wrapper around them."""
    st.table(spark, SF_DIR, "nation")
    monkey = pytest.MonkeyPatch()
    monkey.setattr(st, "apply_settings", lambda session: session)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    monkey.undo()


def stored_legs(spark, folder):
    st.legs(spark, SF_DIR).repartition(8).write.parquet(f"{folder}/legs")
    return spark.read.parquet(f"{folder}/legs")


def test_counting_reads_one_column(fixed_plans):
    df = counts.monthly_counts(st.table(fixed_plans, SF_DIR, "orders"), "o_orderdate")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan(df)
    assert shuffles(df) == 1


def test_cleaning_does_not_shuffle_and_filters_at_the_scan(fixed_plans, folder):
    df = clean.clean(stored_legs(fixed_plans, folder))
    assert shuffles(df) == 0
    assert "IsNotNull(tpep_dropoff_datetime)" in plan(df)


def test_a_months_files_are_filtered_by_a_range_of_times(fixed_plans, folder):
    rows = stored_legs(fixed_plans, folder).withColumnRenamed("tpep_pickup_datetime", PICKUP)
    for name in ("trips_2020-01.parquet", "trips_2020-12.parquet", "other.parquet"):
        rows.coalesce(1).write.parquet(f"{folder}/raw/{name}")
        (part,) = [f for f in os.listdir(f"{folder}/raw/{name}") if f.endswith(".parquet")]
        os.rename(f"{folder}/raw/{name}/{part}", f"{folder}/raw/x-{name}")
    footers = read_footers(list_files(fixed_plans, f"{folder}/raw"))
    fixed_plans.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(clean.clean(read_trips(footers, pickup=PICKUP)))
    fixed_plans.conf.unset("spark.sql.maxMetadataStringLength")
    assert text.count("FileScan") == 3 and "regexp" not in text and "RLIKE" not in text
    for low, high in (("2020-01-01T00:00", "2020-02-01T00:00"), ("2020-12-01T00:00", "2021-01-01T00:00")):
        pushed = [line for line in text.split("\n") if f"GreaterThanOrEqual({PICKUP},{low})" in line]
        assert len(pushed) == 1 and f"LessThan({PICKUP},{high})" in pushed[0].partition("PushedFilters: ")[2]


def test_events_are_built_without_a_shuffle(fixed_plans, folder):
    trips = events.wire_amounts(events.with_defaults(stored_legs(fixed_plans, folder)))
    located = zones.locate_trips(trips, st.nation_zones(fixed_plans, SF_DIR))
    df = events.event_payload(events.with_positions(events.expand_events(located)))
    assert shuffles(df) == 0
    assert "SortMergeJoin" not in plan(df)


def test_statistics_take_one_narrow_pass(fixed_plans, folder):
    df = events.trip_statistics(events.with_defaults(stored_legs(fixed_plans, folder)))
    assert plan(df).count("FileScan") == 1
    assert re.search(r"ReadSchema: struct<tpep_pickup\w+:timestamp_ntz,tpep_dropoff\w+:timestamp_ntz>", plan(df))


def test_medians_project_a_point_once_a_round(fixed_plans, folder):
    st.vertices(fixed_plans, SF_DIR).write.parquet(f"{folder}/vertices")
    df = zones.zone_medians(fixed_plans.read.parquet(f"{folder}/vertices"), cell=1000.0)
    text = plan(df)
    # Latitude takes one inverse tangent at first and one a step.
    assert 0 < text.count("ATAN(") / text.count("FileScan") <= 1 + LATITUDE_STEPS
    assert "IsNotNull(x)" in text and "IsNotNull(y)" in text
    assert "percentile" not in text and "median(" not in text


def test_counting_events_does_not_unfold_them(fixed_plans, folder):
    df = events.event_counts(events.with_defaults(stored_legs(fixed_plans, folder)))
    text = plan(df)
    assert "explode" not in text
    assert re.search(r"ReadSchema: struct<tpep_pickup\w+:timestamp_ntz,tpep_dropoff", text)


def test_a_message_is_parsed_below_the_filter(fixed_plans):
    text = plan(feed.good_events(queries.decoded_messages(fixed_plans, SF_DIR)))
    before_generator = text[: text.index("Generate")]
    assert "parseJson" not in before_generator and "from_json" not in text
    assert text.count("parseJson") == 1
    assert "isnull(problem" in before_generator


def test_hot_zone_is_spread_when_the_table_is_large(fixed_plans, folder):
    df = zones.with_coords(
        stored_legs(fixed_plans, folder), st.nation_zones(fixed_plans, SF_DIR),
        "PULocationID", "pu", small=False, key_rows=5,
    ).select("trip_id", "pu_lat")
    assert "_salt" in plan(df)


@pytest.mark.parametrize(
    "name",
    ["event_payloads", "event_messages", "decode_events", "feed_metrics", "event_positions",
     "reproject", "conform_schema", "clean_all"],
)
def test_generated_methods_are_small_enough_to_compile(fixed_plans, name):
    sizes = method_sizes(fixed_plans, queries.QUERIES[name](fixed_plans, SF_DIR))
    assert sizes and max(sizes) < COMPILED_BYTES


def test_a_whole_event_job_is_small_enough_to_compile(fixed_plans, folder):
    legs = stored_legs(fixed_plans, folder)
    amounts = {n: F.col("fare_amount") for n in events.AMOUNTS if n not in legs.columns}
    legs.withColumns(amounts).write.parquet(f"{folder}/full")
    trips = events.with_defaults(fixed_plans.read.parquet(f"{folder}/full"))
    located = zones.locate_trips(events.wire_amounts(trips), st.nation_zones(fixed_plans, SF_DIR))
    timeline = events.replay_schedule(
        events.with_positions(events.expand_events(located)), 0, 100.0
    )
    df = events.event_payload(timeline, keep=("trip_id", "event", "replay_offset_us"))
    assert max(method_sizes(fixed_plans, df)) < COMPILED_BYTES
