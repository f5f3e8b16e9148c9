"""Work that grows with the tables is dealt over more tasks, and not done again."""

import datetime

import pytest

from tripweave import session
from tripweave.plans import queries as q
from tripweave.plans import standins as st
from tripweave.schema import EVENT_SCHEMA
from tripweave.streaming import feed


@pytest.fixture
def tables(spark, folder):
    """400 events in one row group, and two order lines with all they join to."""
    at = datetime.datetime(2024, 1, 1)
    events = [(i, at, i % 7, "view", 20.0 + i % 5, f'{{"k": {i % 10}}}') for i in range(400)]
    named = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = {
        "events": (events, named),
        "nation": ([(1, 0)], "n_nationkey int, n_regionkey int"),
        "customer": ([(1, 1)], "c_custkey long, c_nationkey int"),
        "supplier": ([(1, 2)], "s_suppkey long, s_nationkey int"),
        "orders": ([(1, 1, at), (2, 1, at)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": (
            [(1, 1, 1, 1, 5.0, at + datetime.timedelta(days=2)), (2, 1, 1, 1, 6.0, at + datetime.timedelta(days=40))],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
            "l_shipdate timestamp_ntz",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "SPREAD_ROWS", 20)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_legs_and_messages_are_dealt_by_rows(spark, tables, small_tasks):
    for df in (st.legs(spark, tables), st.messages(spark, tables)):
        assert df.rdd.getNumPartitions() == 20
        assert df.count() == 400


def test_event_payloads_stay_in_the_tasks_of_their_trips(spark, tables, small_tasks):
    assert q.event_payloads(spark, tables).rdd.getNumPartitions() == 20


def test_a_message_is_walked_once(spark):
    decoded = feed.decode_events(spark.createDataFrame([('{"lat": 1}',)], "value string"))
    assert plan(decoded).count("variant_get(") == 1
    assert decoded.columns == ["value", *EVENT_SCHEMA.fieldNames(), "problem"]


def test_history_decodes_once(spark, tables):
    history = q.feed_history(spark, tables)
    assert "parse_json" not in plan(history)
    (row,) = history.collect()
    assert (row.batch_id, row.total_received, row.total_failed) == (1, 400, 0)


def test_trips_are_joined_once(spark, tables):
    unfolded = q.clean_to_events(spark, tables)
    assert "o_custkey" not in plan(unfolded)
    rows = sorted((r.trip_id, r.event_seq, r.event) for r in unfolded.collect())
    assert rows == [(240101000000001, 0, "PICKUP"), (240101000000001, 1, "IN_TRANSIT"), (240101000000001, 2, "DROPOFF")]


def test_a_batch_of_the_feed_is_dealt_by_rows(spark, tables, small_tasks):
    """The table is a folder here."""
    sent = spark.read.parquet(f"{q.run_feed(spark, tables)}/messages")
    assert sent.count() == 400
    assert len(sent.inputFiles()) == 20


def test_the_feed_counts_a_table_that_is_a_folder(spark, tables):
    (row,) = q.feed_stream_metrics(spark, tables).collect()
    assert (row.received, row.processed, row.batches) == (400, 400, 1)
