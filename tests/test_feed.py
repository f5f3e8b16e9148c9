import json
import os

import pytest
from pyspark.sql import Row

from tripweave.schema import EVENT_SCHEMA
from tripweave.plans import jobs
from tripweave.streaming import feed

FIELDS = [f.name for f in EVENT_SCHEMA.fields]

GOOD = [
    '{"event": "PICKUP", "trip_id": 1, "lat": 40.5, "VendorID": 2, "ts": "t"}',
    '{"event": "IN_TRANSIT", "trip_id": 1, "other": {"x": [1, 2]}}',
    '{"event": "DROPOFF", "trip_id": "12", "fare_amount": "1.5", "payment_type": 1.9}',
    '{"event": "PICKUP", "trip_id": null, "VendorID": ""}',
    "{}",
]
BAD = [
    ('{"event": "PICKUP"', "not JSON"),
    ("", "not JSON"),
    (None, "not JSON"),
    ("[1]", "not JSON"),
    ("12", "not JSON"),
    ('{"trip_id": "abc"}', "wrong type: trip_id"),
    ('{"trip_id": true, "lat": "north"}', "wrong type: trip_id,lat"),
]


def decoded(spark, texts):
    return feed.decode_events(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_good_messages(spark):
    rows = feed.good_events(decoded(spark, GOOD)).collect()
    assert len(rows) == len(GOOD)
    assert (rows[0].event, rows[0].trip_id, rows[0].lat, rows[0].ts) == ("PICKUP", 1, 40.5, "t")
    assert rows[0].DOLocationID is None
    assert (rows[2].trip_id, rows[2].fare_amount, rows[2].payment_type) == (12, 1.5, 1)
    assert rows[3].trip_id is None and rows[3].VendorID is None


def test_bad_messages_are_set_aside_with_the_reason(spark):
    df = decoded(spark, [t for t, _ in BAD] + GOOD)
    got = [(r.value, r.problem) for r in feed.dead_letters(df).collect()]
    assert got == BAD


def test_fields_written_in_other_ways(spark):
    """(field as it is written, event as text, trip_id, lat); a problem's fields in place of the last three."""
    cases = [
        ("1", "1", 1, 1.0), ("1.9", "1.9", 1, 1.9), ("-1.9", "-1.9", -1, -1.9), ("1e3", "1000.0", 1000, 1000.0),
        ('" 7 "', " 7 ", 7, 7.0), ('"1e2"', "1e2", 100, 100.0), ('""', "", None, None), ("null", None, None, None),
        ("0.1", "0.1", 0, 0.1), ("9223372036854775807", "9223372036854775807", 2**63 - 1, 9223372036854775807.0),
    ]
    texts = [f'{{"event": {v}, "trip_id": {v}, "lat": {v}}}' for v, *_ in cases]
    got = [(r.event, r.trip_id, r.lat, r.problem) for r in decoded(spark, texts).collect()]
    assert got == [(*rest, None) for _, *rest in cases]
    problems = {
        '{"trip_id": 92233720368547758080}': "wrong type: trip_id", '{"trip_id": [1], "lat": {"a": 1}}': "wrong type: trip_id,lat",
        '{"trip_id": 1, "trip_id": 2}': None, ' {"trip_id": 3} ': None, "null": "not JSON", '"x"': "not JSON", '[{"trip_id": 1}]': "not JSON",
        '{"trip_id": 01}': "not JSON", '{"lat": true}': "wrong type: lat", '{"event": {"a": [1]}}': None,
    }
    rows = {r.value: r for r in decoded(spark, list(problems)).collect()}
    assert {text: row.problem for text, row in rows.items()} == problems
    assert rows['{"trip_id": 1, "trip_id": 2}'].trip_id == 2 and rows['{"event": {"a": [1]}}'].event == '{"a":[1]}'


def test_messages_are_keyed_and_keep_nulls(spark):
    rows = feed.to_messages(feed.good_events(decoded(spark, GOOD))).collect()
    assert [r.key for r in rows] == ["1", "1", "12", "null", "null"]
    for row in rows:
        assert list(json.loads(row.value)) == FIELDS


def test_metrics(spark):
    rows = [(0, 10, 9, 1), (1, 0, 0, 0), (2, 10, 10, 0)]
    batches = spark.createDataFrame(rows, feed.METRICS_SCHEMA)
    total = feed.feed_metrics(batches).first()
    assert (total.received, total.processed, total.failed, total.batches) == (20, 19, 1, 3)
    assert (total.success_pct, total.success_rate) == (95.0, "95.00%")
    nothing = feed.feed_metrics(batches.limit(0)).first()
    assert (nothing.received, nothing.success_pct, nothing.success_rate) == (0, None, "N/A")
    history = feed.feed_history(batches).orderBy("batch_id").collect()
    assert [r.total_received for r in history] == [10, 10, 20]
    assert [r.success_rate for r in history] == ["90.00%", "90.00%", "95.00%"]


def run(spark, folder, sink=None):
    stream = feed.read_text_feed(spark, f"{folder}/in", files_per_batch=1)
    sink = sink or feed.parquet_sink(f"{folder}/out/messages")
    query = feed.start_feed(
        stream, sink, f"{folder}/out", f"{folder}/checkpoint", trigger={"availableNow": True}
    )
    query.awaitTermination()


def drop_file(folder, name, lines):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as handle:
        handle.write("\n".join(lines) + "\n")


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, folder):
    broken = ['{"event": "PICKUP"', "[1]"]
    drop_file(folder, "a.txt", GOOD + broken)
    drop_file(folder, "b.txt", GOOD)
    run(spark, folder)
    drop_file(folder, "c.txt", broken)
    run(spark, folder)

    sent = spark.read.parquet(f"{folder}/out/messages").select("key", "value").collect()
    batch = feed.to_messages(feed.good_events(decoded(spark, GOOD + GOOD))).collect()
    assert sorted(map(tuple, sent)) == sorted(map(tuple, batch))
    letters = feed.read_dead_letters(spark, f"{folder}/out").collect()
    assert sorted(r.value for r in letters) == sorted(broken + broken)
    total = feed.feed_metrics(feed.read_metrics(spark, f"{folder}/out")).first()
    assert (total.received, total.processed, total.failed, total.batches) == (14, 10, 4, 3)


def test_operators_work_on_a_stream_itself(spark, folder):
    drop_file(folder, "a.txt", GOOD + ["[1]"])
    decoded_stream = feed.decode_events(feed.read_text_feed(spark, f"{folder}/in"))
    query = (
        feed.to_messages(feed.good_events(decoded_stream))
        .writeStream.format("memory").queryName("published").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("published").count() == len(GOOD)


def test_batch_run_again_is_counted_once(spark, folder):
    sink = feed.parquet_sink(f"{folder}/metrics")
    for _ in range(2):
        sink(feed.batch_metrics(decoded(spark, GOOD)), 4)
    assert spark.read.parquet(f"{folder}/metrics").count() == 1


def test_retry_resends_the_batch(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(feed.time, "sleep", waits.append)

    def sink(messages, batch_id):
        calls.append(batch_id)
        if len(calls) < 4:
            raise RuntimeError("broker away")

    feed.with_retry(sink)(None, 9)
    assert calls == [9, 9, 9, 9]
    assert waits == [0.1, 0.2, 0.4]


def test_retry_gives_up(monkeypatch):
    monkeypatch.setattr(feed.time, "sleep", lambda seconds: None)
    calls = []

    def sink(messages, batch_id):
        calls.append(batch_id)
        raise RuntimeError("broker away")

    with pytest.raises(RuntimeError, match="broker away"):
        feed.with_retry(sink, 2)(None, 1)
    assert calls == [1, 1, 1]


def test_console_preview_says_what_it_leaves_out(spark, capsys):
    messages = spark.range(100).selectExpr("'k1' as key", "'some value' as value")
    feed.console_preview(3)(messages, 7)
    out = capsys.readouterr().out
    assert out.count("some value") == 3 and "batch 7: 3 of 100 messages shown" in out


def test_totals_are_reported_while_running(capsys):
    totals = feed.FeedTotals(every=0.0)
    totals.add(Row(received=4, processed=3, failed=1))
    totals.add(Row(received=0, processed=0, failed=0))
    assert "received 4, processed 3, failed 1, batches 2, success 75.00%" in capsys.readouterr().out


def test_a_repeated_batch_is_counted_once(spark, folder):
    for _ in range(2):
        feed.record_metrics(spark, folder, 1002, Row(received=5, processed=4, failed=1))
    feed.record_metrics(spark, folder, 3, Row(received=1, processed=1, failed=0))
    total = feed.feed_metrics(feed.read_metrics(spark, folder)).first()
    assert (total.received, total.batches) == (6, 2)
    assert sorted(os.listdir(f"{folder}/metrics")) == ["group=0", "group=1"]


@pytest.mark.parametrize("preview", [False, True])
def test_feed_job_keeps_every_message_in_limited_batches(spark, folder, preview):
    for name in "abc":
        drop_file(folder, f"{name}.txt", GOOD * 20 + ["[1]"])
    query = jobs.feed_job(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", once=True, batch_files=1, preview=preview
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out/messages").count() == 60 * len(GOOD)
    total = feed.feed_metrics(feed.read_metrics(spark, f"{folder}/out")).first()
    assert (total.batches, total.failed) == (3, 3)


def test_a_restarted_feed_goes_on_counting(spark, folder, capfd):
    drop_file(folder, "a.txt", GOOD + ["[1]"])
    run(spark, folder)
    drop_file(folder, "b.txt", GOOD)
    run(spark, folder)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for _ in range(100):
        out = capfd.readouterr().out
        if "batches 2" in out:
            break
        feed.time.sleep(0.1)
    assert f"received {2 * len(GOOD) + 1}, processed {2 * len(GOOD)}, failed 1, batches 2" in out


def test_a_batch_that_was_recorded_is_not_counted_again():
    totals = feed.FeedTotals(1e9, Row(received=10, processed=9, failed=1, batches=2), last_batch=4)
    totals.add(Row(received=5, processed=5, failed=0), 4)
    totals.add(Row(received=2, processed=2, failed=0), 5)
    assert totals.text().startswith("received 12, processed 11, failed 1, batches 3")


def test_few_large_files_make_several_batches(spark, folder):
    for name in "abcd":
        drop_file(folder, f"{name}.txt", GOOD * 500)
    size = os.path.getsize(f"{folder}/in/a.txt")
    query = jobs.feed_job(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", once=True, batch_bytes=2 * size)
    query.awaitTermination()
    assert feed.feed_metrics(feed.read_metrics(spark, f"{folder}/out")).first().batches == 2
    assert spark.read.parquet(f"{folder}/out/messages").count() == 2000 * len(GOOD)


def test_a_topic_batch_waits_for_messages_but_not_long():
    assert feed.topic_options(1000) == {
        "maxOffsetsPerTrigger": "1000", "minOffsetsPerTrigger": "500", "maxTriggerDelay": "50ms"}
    assert feed.topic_options(least_messages=None) == {}
