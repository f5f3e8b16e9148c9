import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripweave.operators import drift
from tripweave.plans import jobs
from tripweave.schema import DROPOFF, PICKUP, TRIP_SCHEMA
from tripweave.sources import files as fl
from tripweave.sources.trips import preview, read_trips
from tripweave.streaming import feed


def at(text):
    return datetime.fromisoformat(text)


def put(root, name, columns):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def times(*texts):
    return pa.array([None if t is None else at(t) for t in texts], pa.timestamp("us"))


def longs(*values):
    return pa.array(values, pa.int64())


@pytest.fixture
def raw(folder):
    """Monthly files of several eras."""
    root = f"{folder}/raw"
    put(root, "2009/trips_2009-01.parquet", {
        "vendor_name": ["x"], "Trip_Pickup_DateTime": ["2009-01-01 00:00:00"], "Start_Lon": [1.0],
    })
    put(root, "2011/trips_2011-05.parquet", {
        PICKUP: times("2011-05-01 10:00:00", "2011-05-01 09:00:00", "2011-06-01 00:00:00",
                      "2011-05-02 00:00:00", "2011-05-02 00:00:00", None),
        DROPOFF: times("2011-05-01 10:10:00", "2011-05-01 09:00:00", "2011-06-01 00:10:00",
                       "2011-05-01 23:59:59", "2011-05-02 00:00:31", "2011-05-02 00:00:31"),
        "PULocationID": longs(1, 1, 1, 1, None, 1), "DOLocationID": longs(2, 2, 2, 2, 2, 2),
        "airport_fee": pa.nulls(6),
    })
    put(root, "2019/trips_2019-02.parquet", {
        PICKUP: times("2019-02-03 10:00:00", "2019-02-03 10:00:00", "2019-02-03 10:00:00"),
        DROPOFF: times("2019-02-03 10:01:01", "2019-02-03 10:00:30", "2019-02-03 10:00:30"),
        "PULocationID": longs(4, 264, 4), "DOLocationID": longs(5, 5, 265),
        "passenger_count": pa.array([1.9, float("nan"), 2.0]), "airport_fee": [1.25, 0.0, 0.0],
    })
    put(root, "2023/trips_2023-03.parquet", {
        PICKUP: pa.array([at("2023-03-03 10:00:00")], pa.timestamp("ns")),
        DROPOFF: pa.array([at("2023-03-03 10:00:20")], pa.timestamp("ns")),
        "PULocationID": pa.array([4], pa.int32()), "DOLocationID": pa.array([5], pa.int32()),
        "store_and_fwd_flag": pa.array(["N"], pa.large_string()), "Airport_fee": [1.75],
        "VendorID": pa.array(["2"]).dictionary_encode(),
    })
    put(root, "2025/trips 2025-01.parquet", {
        PICKUP: times("2025-01-03 10:00:00"), DROPOFF: times("2025-01-03 10:00:20"),
        "PULocationID": longs(4), "DOLocationID": longs(5), "cbd_congestion_fee": [0.75],
    })
    put(root, "other.parquet", {"a": [1]})
    put(root, "trips_2020-13.parquet", {"a": [1]})
    open(f"{root}/2011/trips_2011-06.parquet", "w").close()
    return root


def test_listing(spark, raw):
    rows = {r["name"]: r for r in fl.list_files(spark, raw).collect()}
    assert len(rows) == 8
    assert rows["trips_2011-06.parquet"].length == 0
    assert (rows["trips 2025-01.parquet"].year, rows["trips 2025-01.parquet"].month) == (2025, 1)
    assert rows["trips_2020-13.parquet"].year is None
    assert rows["other.parquet"].label == "other"
    picked = fl.in_period_range(fl.list_files(spark, raw), (2011, 6), (2023, 3)).collect()
    assert sorted(r.label for r in picked) == ["2011-06", "2019-02", "2023-03"]


def test_footers(spark, raw):
    footers = fl.read_footers(fl.list_files(spark, raw))
    counted = {r.file.rsplit("/", 1)[1]: r.row_count for r in fl.file_counts(footers).collect()}
    assert counted == {"trips_2009-01.parquet": 1, "trips_2011-05.parquet": 6,
                       "trips_2019-02.parquet": 3, "trips_2023-03.parquet": 1,
                       "trips 2025-01.parquet": 1}
    types = {(r.label, r.column): r.type for r in fl.file_schemas(footers).collect()}
    assert types["2011-05", "airport_fee"] == "null"
    assert types["2023-03", "PULocationID"] == "int32"
    assert types["2023-03", "store_and_fwd_flag"] == "large_string"
    lacking = fl.missing_columns(footers, [PICKUP, "trip_id"]).collect()
    assert sorted(len(r.missing) for r in lacking) == [1, 1, 1, 1, 2, 2, 2]


def test_unreadable_file(spark, raw):
    with open(f"{raw}/trips_2020-05.parquet", "w") as handle:
        handle.write("not a parquet file at all")
    files = fl.list_files(spark, raw)
    with pytest.raises(Exception, match="Invalid|magic|Parquet"):
        fl.read_footers(files).collect()
    broken = fl.read_footers(files, skip_unreadable=True).where("n_rows is null").collect()
    assert [r.path.rsplit("/", 1)[1] for r in broken] == ["trips_2020-05.parquet"]


def test_whole_pipeline(spark, raw, folder):
    result = jobs.clean_job(spark, raw, f"{folder}/clean", report=f"{folder}/clean-report").collect()
    status = {r.status: r.n_files for r in result}
    assert status == {"processed": 4, "skipped_empty": 1, "skipped_out_of_range": 3}
    assert {r.status: (r.rows_in, r.rows_kept) for r in result} == {
        "processed": (11, 6), "skipped_empty": (None, None), "skipped_out_of_range": (None, None)}
    report = spark.read.option("header", True).csv(f"{folder}/clean-report").collect()
    assert {r.path[-15:-8]: (r.rows_in, r.rows_kept) for r in report} == {
        "2011-05": ("6", "3"), "2019-02": ("3", "1"), "2023-03": ("1", "1"), "2025-01": ("1", "1")}

    cleaned = spark.read.parquet(f"{folder}/clean")
    assert [f.name for f in TRIP_SCHEMA.fields] == cleaned.columns[:19]
    rows = {(r.year, r.src_row): r for r in cleaned.collect()}
    assert sorted(rows) == [(2011, 0), (2011, 1), (2011, 4), (2019, 0), (2023, 0), (2025, 0)]
    assert rows[2019, 0].passenger_count == 1 and rows[2019, 0].Airport_fee == 1.25
    assert rows[2023, 0].Airport_fee == 1.75 and rows[2023, 0].VendorID == 2
    assert str(rows[2023, 0][PICKUP]) == "2023-03-03 10:00:00"
    assert rows[2011, 4].PULocationID is None and rows[2011, 0].Airport_fee is None

    jobs.identify_job(spark, f"{folder}/clean", f"{folder}/ids")
    ids = {(r.year, r.src_row): r.trip_id for r in spark.read.parquet(f"{folder}/ids").collect()}
    assert ids == {(2011, 1): 110501000000001, (2011, 0): 110501000000002,
                   (2011, 4): 110502000000001, (2019, 0): 190203000000001,
                   (2023, 0): 230303000000001, (2025, 0): 250103000000001}
    with pytest.raises(ValueError, match="already"):
        jobs.identify_job(spark, f"{folder}/ids", f"{folder}/again")

    with open(f"{folder}/zones.csv", "w") as handle:
        handle.write("LocationID,longitude,latitude\n4,-73.0,40.0\n5,-74.0,41.0\n")
    counted = jobs.expand_job(spark, f"{folder}/ids", f"{folder}/zones.csv", f"{folder}/events",
                              start=(2012, 1), end=(2023, 3), ordered=True)
    assert {r.event: r.n_events for r in counted.collect()} == {
        "PICKUP": 2, "IN_TRANSIT": 2, "DROPOFF": 2, "sent": 6}
    out = spark.read.parquet(f"{folder}/events").orderBy("event_time_us").collect()
    assert [r.event for r in out] == ["PICKUP", "IN_TRANSIT", "IN_TRANSIT", "DROPOFF",
                                      "PICKUP", "DROPOFF"]
    assert out[1].replay_offset_us == 300_000
    assert '"lat":40.0,"lon":-73.0' in out[0].value and '"lat":41.0,"lon":-74.0' in out[5].value


def test_expand_leaves_out_files_without_ids(spark, folder):
    columns = {PICKUP: longs(1_580_702_706), DROPOFF: longs(1_580_702_736_000),
               "PULocationID": longs(4), "DOLocationID": longs(5)}
    put(f"{folder}/ids", "trips_2020-02.parquet", {**columns, "trip_id": longs(7)})
    put(f"{folder}/ids", "trips_2020-03.parquet", columns)
    with open(f"{folder}/ids/trips_2020-04.parquet", "w") as handle:
        handle.write("not a parquet file at all")
    footers = jobs.identified_footers(spark, f"{folder}/ids", (2020, 1), (2024, 4))
    trips = jobs.read_identified(footers).collect()
    assert [(r.trip_id, r.dropoff_us - r.pickup_us) for r in trips] == [(7, 30_000_000)]
    report = fl.ingested_rows(footers, jobs.EXPAND_NEEDS).orderBy("path").collect()
    assert [(r.n_rows, r.missing, r.n_ingested) for r in report] == [
        (1, [], None), (1, ["trip_id"], None), (None, jobs.EXPAND_NEEDS, None)]
    counted = jobs.expand_job(spark, f"{folder}/ids", write_zones(folder), f"{folder}/events",
                              report=f"{folder}/report")
    assert {r.event: r.n_events for r in counted.collect()}["sent"] == 2
    report = spark.read.option("header", True).csv(f"{folder}/report").orderBy("path").collect()
    assert [(r.n_rows, r.n_ingested, r.n_lost) for r in report] == [("1", "1", "0"), ("1", "0", "1"), (None, "0", None)]


def test_expand_counts_what_it_wrote(spark, folder):
    """One row group cannot be decoded; a footer is cut off; a time overflows."""
    n = 30_000
    columns = {
        PICKUP: pa.array([1_580_702_706_000_000 + i for i in range(n)], pa.timestamp("us")),
        DROPOFF: pa.array([1_580_702_736_000_000 + i for i in range(n)], pa.timestamp("us")),
        "PULocationID": longs(*[4] * n), "DOLocationID": longs(*[5] * n), "trip_id": longs(*range(n)),
        "total_amount": pa.array([float(i) for i in range(n)]),
    }
    path = f"{folder}/ids/trips_2020-02.parquet"
    os.makedirs(f"{folder}/ids")
    pq.write_table(pa.table(columns), path, row_group_size=n // 3, compression="zstd", use_dictionary=False)
    chunk = pq.ParquetFile(path).metadata.row_group(1).column(5)
    with open(path, "r+b") as handle:
        handle.seek(chunk.data_page_offset + 40)
        handle.write(os.urandom(min(2000, chunk.total_compressed_size - 60)))
    whole = open(path, "rb").read()
    with open(f"{folder}/ids/trips_2020-03.parquet", "wb") as handle:
        handle.write(whole[:-300] + b"\xff" * 292 + whole[-8:])
    counted = jobs.expand_job(spark, f"{folder}/ids", write_zones(folder), f"{folder}/events",
                              report=f"{folder}/report")
    counts = {r.event: r.n_events for r in counted.collect()}
    written = spark.read.parquet(f"{folder}/events")
    assert counts["sent"] == written.count() and counts["PICKUP"] == written.where("event = 'PICKUP'").count()
    assert 0 < counts["PICKUP"] < n
    good, broken = spark.read.option("header", True).csv(f"{folder}/report").orderBy("path").collect()
    assert int(good.n_ingested) == counts["PICKUP"] and int(good.n_lost) == n - counts["PICKUP"]
    assert (broken.n_rows, broken.n_ingested) == (None, "0")


@pytest.mark.parametrize("ordered", [False, True])
def test_a_bad_row_group_takes_no_other_with_it(spark, folder, ordered):
    """Of five row groups the second and fourth are broken; another file is sound."""
    n, groups = 5_000, 5
    times = pa.array([1_580_702_706_000_000 + i for i in range(n * groups)], pa.timestamp("us"))
    columns = {PICKUP: times, DROPOFF: times, "PULocationID": longs(*[4] * n * groups), "DOLocationID": longs(*[5] * n * groups),
               "trip_id": longs(*range(n * groups)), "total_amount": pa.array([i * 1.1 for i in range(n * groups)])}
    path = f"{folder}/ids/trips_2020-02.parquet"
    os.makedirs(f"{folder}/ids")
    pq.write_table(pa.table(columns), path, row_group_size=n, compression="zstd", use_dictionary=False)
    with open(path, "r+b") as handle:
        for group in (1, 3):
            chunk = pq.ParquetFile(path).metadata.row_group(group).column(5)
            handle.seek(chunk.data_page_offset)
            handle.write(b"\xff" * 200)
    put(f"{folder}/ids", "trips_2020-03.parquet", {name: column[:7] for name, column in columns.items()})
    footers = jobs.identified_footers(spark, f"{folder}/ids", (2020, 1), (2024, 4))
    assert jobs.read_identified(footers).where("trip_id >= 7 and total_amount >= 0").count() <= n
    counted = jobs.expand_job(spark, f"{folder}/ids", write_zones(folder), f"{folder}/events", ordered=ordered, report=f"{folder}/report")
    assert {r.event: r.n_events for r in counted.collect()} == {
        "PICKUP": 3 * n + 7, "IN_TRANSIT": 0, "DROPOFF": 3 * n + 7, "sent": 6 * n + 14}
    trips = sorted(r.trip_id for r in spark.read.parquet(f"{folder}/events").where("event = 'PICKUP'").select("trip_id").collect())
    assert trips == sorted([*range(7), *range(n), *range(2 * n, 3 * n), *range(4 * n, 5 * n)])
    report = spark.read.option("header", True).csv(f"{folder}/report").orderBy("path").collect()
    assert [(r.n_ingested, r.n_lost) for r in report] == [(str(3 * n), str(2 * n)), ("7", "0")]


def test_expand_reports_times_it_cannot_count(spark, folder):
    put(f"{folder}/ids", "trips_2020-02.parquet", {
        PICKUP: longs(-9_000_000_000_000_000_000), DROPOFF: longs(9_000_000_000_000_000_000),
        "PULocationID": longs(4), "DOLocationID": longs(5), "trip_id": longs(7)})
    trips = spark.createDataFrame([(-(2**62), 2**62), (0, 31_000_000)], "pickup_us long, dropoff_us long")
    seen = jobs.events.trip_statistics(trips).first()
    assert (seen.most_ticks, seen.first_event_us, seen.n_uncountable) == (1, -(2**62), 1)
    counted = {"PICKUP": 1, "IN_TRANSIT": 0, "DROPOFF": 1, "sent": 2}
    rows = {r.event: r.n_events for r in jobs.written_counts(spark, counted, 1).collect()}
    assert rows == {"PICKUP": 1, "IN_TRANSIT": 0, "DROPOFF": 1, "sent": 2, "UNCOUNTABLE": 1}


def test_identify_takes_files_as_they_come(spark, folder):
    """An empty file, a column of one file only, a missing pickup, a zone of another width."""
    root = f"{folder}/clean"
    put(root, "trips_2020-02.parquet", {PICKUP: times("2020-02-03 10:00:00", None), "a": longs(1, 2)})
    put(root, "trips_2020-03.parquet", {PICKUP: times("2020-03-03 10:00:00"), "tip_amount": [1.5]})
    open(f"{root}/trips_2020-04.parquet", "w").close()
    jobs.identify_job(spark, root, f"{folder}/ids")
    rows = spark.read.option("mergeSchema", True).parquet(f"{folder}/ids").collect()
    got = sorted((r.year, r.month, r.src_row, r.trip_id, r.a, r.tip_amount) for r in rows)
    assert got == [(2020, 2, 0, 200203000000001, 1, None), (2020, 2, 1, None, 2, None),
                   (2020, 3, 0, 200303000000001, None, 1.5)]
    footers = jobs.identified_footers(spark, f"{folder}/ids", (2020, 2), (2020, 2))
    assert sum(r.n for r in footers.groupBy("path").agg(F.max("n_rows").alias("n")).collect()) == 2


def test_clean_with_nothing_in_the_period(spark, folder):
    put(f"{folder}/raw", "trips_2009-01.parquet", {"a": [1]})
    status = jobs.clean_job(spark, f"{folder}/raw", f"{folder}/clean").collect()
    assert [(r.status, r.n_files) for r in status] == [("skipped_out_of_range", 1)]
    assert (status[0].rows_in, status[0].rows_kept) == (None, None)


def test_files_as_spark_writes_them(spark, folder):
    """Timestamps of twelve bytes, both spellings of a column, times as other numbers."""
    moment = "timestamp'2020-02-03 10:00:00'"
    spark.sql(f"select {moment} as {PICKUP}, {moment} as {DROPOFF}, 1.5D as Airport_fee, 2.5D as airport_fee") \
        .coalesce(1).write.parquet(f"{folder}/written")
    (part,) = [f for f in os.listdir(f"{folder}/written") if f.endswith(".parquet")]
    os.makedirs(f"{folder}/raw")
    os.rename(f"{folder}/written/{part}", f"{folder}/raw/trips_2020-02.parquet")
    put(f"{folder}/raw", "trips_2020-03.parquet", {PICKUP: pa.array([5], pa.int32()), DROPOFF: [1.5]})
    footers = fl.read_footers(fl.list_files(spark, f"{folder}/raw"))
    assert {r.physical for r in footers.where(f"column = '{PICKUP}'").collect()} == {"INT96", "INT32"}
    first, second = read_trips(footers).orderBy(F.col("src_file")).collect()
    assert str(first[PICKUP]) == "2020-02-03 10:00:00" and first.Airport_fee == 1.5
    assert str(second[PICKUP]) == "1970-01-01 00:00:00.000005" and second[DROPOFF] is None
    jobs.clean_job(spark, f"{folder}/raw", f"{folder}/clean")
    assert spark.read.parquet(f"{folder}/clean").count() == 1


def test_written_events_are_fed(spark, folder):
    put(f"{folder}/ids", "trips_2020-02.parquet", {
        PICKUP: times("2020-02-03 10:00:00", "2020-02-03 11:00:00"),
        DROPOFF: times("2020-02-03 10:10:00", "2020-02-03 11:00:31"), "fare_amount": [1.5, 2.5],
        "PULocationID": longs(4, 4), "DOLocationID": longs(5, 5), "trip_id": longs(1, 2)})
    jobs.expand_job(spark, f"{folder}/ids", write_zones(folder), f"{folder}/events")
    feed.start_feed(
        feed.read_event_feed(spark, f"{folder}/events", files_per_batch=1),
        feed.parquet_sink(f"{folder}/sent"), f"{folder}/out", f"{folder}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    sent = spark.read.parquet(f"{folder}/sent").groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in sent} == {"1": 21, "2": 3}
    assert feed.read_dead_letters(spark, f"{folder}/out").count() == 0
    total = feed.feed_metrics(feed.read_metrics(spark, f"{folder}/out")).first()
    assert (total.received, total.success_rate) == (24, "100.00%")


def write_zones(folder):
    with open(f"{folder}/zones.csv", "w") as handle:
        handle.write("LocationID,longitude,latitude\n4,-73.0,40.0\n5,-74.0,41.0\n")
    return f"{folder}/zones.csv"


def test_times_are_checked_per_file(spark, folder):
    put(f"{folder}/ids", "trips_2020-02.parquet", {
        PICKUP: longs(0, 1_580_702_706), DROPOFF: times(None, "1999-01-01")})
    put(f"{folder}/ids", "trips_2020-03.parquet", {"trip_id": longs(1)})
    jobs.check_times_job(spark, f"{folder}/ids", f"{folder}/times", (2020, 1), (2020, 3))
    rows = spark.read.option("header", True).csv(f"{folder}/times").collect()
    got = {r.column: (r.raw, r.iso, r.in_range, r.n_rows, r.n_in_range) for r in rows}
    assert got == {
        PICKUP: ("1580702706", "2020-02-03T04:05:06Z", "true", "2", "1"),
        DROPOFF: ("915148800000000", "1999-01-01T00:00:00Z", "false", "2", "0"),
    }


def test_a_trip_with_a_wrong_time_is_spread(spark, folder, monkeypatch):
    monkeypatch.setattr(jobs.events, "LONG_TRIP", 1000)
    put(f"{folder}/ids", "trips_2020-02.parquet", {
        PICKUP: times("2020-02-03 10:00:00", "2020-02-03 10:00:00"),
        DROPOFF: times("2020-02-03 10:10:00", "2020-03-03 10:10:00"),
        "PULocationID": longs(4, 4), "DOLocationID": longs(5, 5), "trip_id": longs(1, 2)})
    counted = jobs.expand_job(spark, f"{folder}/ids", write_zones(folder), f"{folder}/events")
    sent = {r.event: r.n_events for r in counted.collect()}["sent"]
    assert sent > 80_000
    assert spark.read.parquet(f"{folder}/events").count() == sent


def test_profile(spark, raw, folder):
    summary = jobs.profile_job(spark, raw, f"{folder}/reports").first()
    assert (summary.total_rows, summary.n_files, summary.n_mismatches) == (12, 7, 6)
    assert str(summary.first_month) == "2009-01-01" and str(summary.last_month) == "2025-01-01"

    def report(name):
        return spark.read.option("header", True).csv(f"{folder}/reports/{name}").collect()

    columns = {r.column: r for r in report("schema_column_summary")}
    assert columns["airport_fee"].types_seen == "double|null"
    assert columns["airport_fee"].files_with_column_list == "2011-05|2019-02"
    assert columns["airport_fee"].files_missing_column == "5"
    assert columns["a"].files_with_column_list == "other|trips_2020-13"
    assert columns["PULocationID"].types_seen == "int32|int64"
    assert [r.column for r in report("schema_baseline")] == [
        "vendor_name", "Trip_Pickup_DateTime", "Start_Lon"]
    assert len(report("schema_mismatches")) == 6
    assert [r.row_count for r in report("yearly_totals")] == ["1", "6", "3", "1", "1"]
    assert len(report("monthly_counts")) == 5 and len(report("monthly_stats")) == 5


def test_first_file_goes_folder_by_folder(spark, folder):
    put(f"{folder}/raw", "a-b/x.parquet", {"second": [1]})
    put(f"{folder}/raw", "a/x.parquet", {"first": [1], "second": [1]})
    put(f"{folder}/raw", "b.parquet", {"first": [2], "second": [2]})
    schemas = fl.file_schemas(fl.read_footers(fl.list_files(spark, f"{folder}/raw")))
    assert [r.column for r in drift.baseline(schemas).collect()] == ["first", "second"]
    (row,) = drift.schema_diff(schemas).collect()
    assert row.file.endswith("a-b/x.parquet")
    assert (row.missing_cols, row.extra_cols) == (["first: int64"], [])


def test_locate(spark, folder):
    rows = [(0, "7", 990000.0, 180000.0), (1, "264", 1.0, 1.0), (2, "3", 985000.0, 1.0)]
    spark.createDataFrame(rows, "shape_seq bigint, LocationID string, x double, y double") \
        .write.parquet(f"{folder}/vertices")
    assert jobs.locate_job(spark, f"{folder}/vertices", f"{folder}/zones") == 2
    out = spark.read.option("header", True).csv(f"{folder}/zones")
    assert out.columns == ["LocationID", "longitude", "latitude"]
    assert sorted(r.LocationID for r in out.collect()) == ["3", "7"]
    assert jobs.locate_job(spark, f"{folder}/vertices", f"{folder}/all", True) == 3


def test_vertex_columns_go_by_name(spark, folder):
    with open(f"{folder}/vertices.csv", "w") as handle:
        handle.write("y,location_id,shape_seq,x,more\n180000,7,0,990000,a\nbad,7,0,990000,b\n180000,7,,990000,c\n")
    rows = jobs.read_vertices(spark, f"{folder}/vertices.csv").collect()
    assert [(r.shape_seq, r.location_id, r.x, r.y) for r in rows] == [
        (0, "7", 990000.0, 180000.0), (0, "7", 990000.0, None), (None, "7", 990000.0, 180000.0)]
    assert jobs.locate_job(spark, f"{folder}/vertices.csv", f"{folder}/zones") == 2
    with open(f"{folder}/other.csv", "w") as handle:
        handle.write("a,LocationID\n1,2\n")
    with pytest.raises(ValueError, match="missing columns: shape_seq, x, y"):
        jobs.read_vertices(spark, f"{folder}/other.csv")


def test_reading_nothing(spark, folder):
    put(f"{folder}/raw", "other.parquet", {"a": [1]})
    none = fl.read_footers(fl.list_files(spark, f"{folder}/raw").where(F.lit(False)))
    with pytest.raises(ValueError, match="no files"):
        read_trips(none)


def test_every_stored_type_is_read(spark, folder):
    whole = ["int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64"]
    kinds = [getattr(pa, k)() for k in whole] + [pa.float32(), pa.float64(), pa.decimal128(25, 2)]
    kinds += [pa.dictionary(pa.int32(), pa.int64())]
    for i, kind in enumerate(kinds):
        value = pa.array([7]).cast(pa.int64() if pa.types.is_dictionary(kind) else kind)
        column = value.dictionary_encode() if pa.types.is_dictionary(kind) else value
        put(f"{folder}/raw", f"n{i}.parquet", {"VendorID": column, "extra": column})
    moment = at("2020-02-03 00:00:00")
    stamps = [pa.timestamp(u) for u in ("s", "ms", "us", "ns")]
    stamps += [pa.timestamp("us", "UTC"), pa.timestamp("ns", "UTC"), pa.date32(), pa.date64()]
    for i, kind in enumerate(stamps):
        column = pa.array([moment], pa.timestamp("us")).cast(kind)
        put(f"{folder}/raw", f"t{i}.parquet", {PICKUP: column, DROPOFF: column})
    footers = fl.read_footers(fl.list_files(spark, f"{folder}/raw"))
    trips = read_trips(footers)
    numbers = trips.where("VendorID is not null").collect()
    assert [(r.VendorID, r.extra) for r in numbers] == [(7, 7.0)] * len(kinds)
    moments = trips.where(f"{PICKUP} is not null").collect()
    assert [r[PICKUP] for r in moments] == [moment] * len(stamps)
    assert trips.count() == len(kinds) + len(stamps)


def test_odd_file_names(spark, folder):
    names = ["a[1] 2020-02.parquet", "b{x,y}2020-02.parquet", "c+d%41é 2020-02.parquet"]
    for i, name in enumerate(names):
        put(f"{folder}/raw", name, {"VendorID": longs(i)})
    files = fl.list_files(spark, f"{folder}/raw")
    assert sorted(r["name"] for r in files.collect()) == sorted(names)
    assert files.where("length > 0").count() == len(names)
    trips = read_trips(fl.read_footers(files))
    assert sorted(r.VendorID for r in trips.collect()) == [0, 1, 2]


def test_preview(spark, raw):
    assert preview(spark, f"{raw}/2011/trips_2011-05.parquet").count() == 5


def test_arguments():
    options = jobs.parse_arguments(["expand", "a", "b", "c", "--start", "2021-03", "--ordered"])
    assert (options.start, options.end, options.ordered) == ((2021, 3), (2024, 4), True)
    with pytest.raises(SystemExit):
        jobs.parse_arguments(["clean", "a", "b", "--start", "2021-13"])


def test_a_second_profile_opens_no_footer_of_an_unchanged_file(spark, folder):
    root, kept = f"{folder}/raw", f"{folder}/manifest"
    for month, rows in (("01", 3), ("02", 5)):
        put(root, f"trips_2020-{month}.parquet", {"a": longs(*range(rows))})
    first = jobs.profile_job(spark, root, f"{folder}/reports", kept).first()
    # The same length and time, and nothing to read: opened, it would fail.
    path = f"{root}/trips_2020-01.parquet"
    seen = os.stat(path)
    with open(path, "wb") as handle:
        handle.write(b"x" * seen.st_size)
    os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    assert jobs.profile_job(spark, root, f"{folder}/again", kept).first() == first
    put(root, "trips_2020-02.parquet", {"a": longs(*range(50))})
    put(root, "trips_2020-03.parquet", {"b": longs(1)})
    after = jobs.profile_job(spark, root, f"{folder}/third", kept).first()
    assert (first.total_rows, after.total_rows, after.n_files) == (8, 54, 3)
    assert jobs.profile_job(spark, root, f"{folder}/fourth", kept).first() == after
    os.remove(f"{root}/trips_2020-03.parquet")
    assert jobs.profile_job(spark, root, f"{folder}/fifth", kept).first().total_rows == 53


def test_identify_refuses_columns_that_its_folders_are_named_by(spark, folder):
    put(f"{folder}/clean", "trips_2020-02.parquet", {PICKUP: times("2020-02-03 10:00:00"), "year": longs(7)})
    with pytest.raises(ValueError, match="year and month"):
        jobs.identify_job(spark, f"{folder}/clean", f"{folder}/ids")
