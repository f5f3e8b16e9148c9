"""The batch jobs from raw monthly files to events, and the feed.

    python -m tripweave.plans.jobs clean   RAW CLEANED
    python -m tripweave.plans.jobs identify CLEANED IDENTIFIED
    python -m tripweave.plans.jobs locate  VERTICES ZONES_CSV
    python -m tripweave.plans.jobs expand  IDENTIFIED ZONES_CSV EVENTS
    python -m tripweave.plans.jobs check-times IDENTIFIED REPORT
    python -m tripweave.plans.jobs profile FILES REPORTS
    python -m tripweave.plans.jobs feed    MESSAGES OUTPUT CHECKPOINT
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.functions.times import epoch_micros
from tripweave.operators import counts, drift, events, zones
from tripweave.operators.clean import clean
from tripweave.operators.identify import add_trip_id
from tripweave.operators.ordering import events_in_time_order
from tripweave.schema import (
    CLEAN_END,
    CLEAN_START,
    DROPOFF,
    PICKUP,
    SOURCE_FILE,
    SOURCE_ROW,
    STEP_US,
    TRIP_ID,
    TRIP_SCHEMA,
)
from tripweave.session import build_session, spread, store
from tripweave.sources import files as fl
from tripweave.sources.tables import read_vertices, read_zones, write_csv
from tripweave.sources.trips import read_as_stored, read_files, read_trips, write_by_month
from tripweave.streaming import feed

# Fixed values of the event job.
EXPAND_NEEDS = [PICKUP, DROPOFF, TRIP_ID]
EXPAND_START = (2020, 1)
EXPAND_END = (2024, 4)
PLAYBACK_SPEED = 100.0
KINDS = ("PICKUP", "IN_TRANSIT", "DROPOFF")

# Rows of a job's result that are printed; the rest is counted, and in what the job wrote.
SHOWN_ROWS = 200


def clean_job(
    spark: SparkSession,
    source: str,
    target: str,
    start: tuple[int, int] = CLEAN_START,
    end: tuple[int, int] = CLEAN_END,
    report: str | None = None,
) -> DataFrame:
    """Conform and filter the monthly files of a period.

    Returns files per status: status, n_files and, of those processed, rows_in
    and rows_kept. Rows in are what the footers say; rows kept are counted as
    they are written. `report` names a folder for the same per file, for which
    what was written is read once more. With no file in the period nothing is
    written.
    """
    files = fl.with_status(fl.list_files(spark, source), start, end)
    footers = store(fl.read_footers(files.where(F.col("status") == "processed")), "footers")
    per_file = footers.groupBy("path").agg(F.max("n_rows").alias("rows_in"))
    rows_in = per_file.agg(F.sum("rows_in")).first()[0]
    rows_kept = None
    if rows_in is not None:
        written = Observation()
        kept = clean(read_trips(footers, pickup=PICKUP))
        write_by_month(kept.observe(written, F.count("*").alias("rows_kept")), target)
        rows_kept = written.get["rows_kept"]
        if report:
            stored = spark.read.parquet(target).groupBy(F.col(SOURCE_FILE).alias("path"))
            stored = stored.agg(F.count("*").alias("rows_kept")).withColumn("path", fl.listed_path(F.col("path")))
            counted = per_file.join(stored, "path", "left")
            write_csv(counted.select("path", "rows_in", F.coalesce("rows_kept", F.lit(0)).alias("rows_kept")).orderBy("path"), report)
    taken = F.col("status") == "processed"
    return fl.status_counts(files).withColumns(
        {
            "rows_in": F.when(taken, F.lit(rows_in).cast("bigint")),
            "rows_kept": F.when(taken, F.lit(rows_kept).cast("bigint")),
        }
    )


def identify_job(spark: SparkSession, source: str, target: str) -> None:
    """Give every trip its id; trips keep the order of the file they first came from.

    Files are read as they are, each with its own columns; empty ones are left
    out. A trip without a pickup keeps a null id and its file's month. Files
    that hold columns named like the folders that are written are refused.
    """
    footers = store(fl.read_footers(fl.list_files(spark, source)), "footers")
    if not footers.where(F.col("column").isin("year", "month")).isEmpty():
        raise ValueError("columns year and month are taken by the folders of the result")
    trips = read_as_stored(footers).drop("year", "month")
    write_by_month(add_trip_id(trips), target)


def locate_job(
    spark: SparkSession, source: str, target: str, include_unknown: bool = False
) -> int:
    """Write the median coordinate of every outline; returns how many there are."""
    medians = store(zones.zone_medians(read_vertices(spark, source), include_unknown), "zones")
    ordered = medians.orderBy("LocationID", "shape_seq")
    write_csv(ordered.select("LocationID", "longitude", "latitude"), target)
    return medians.count()


def expand_job(
    spark: SparkSession,
    source: str,
    zone_file: str,
    target: str,
    start: tuple[int, int] = EXPAND_START,
    end: tuple[int, int] = EXPAND_END,
    step_us: int = STEP_US,
    speed: float = PLAYBACK_SPEED,
    slice_us: int | None = None,
    ordered: bool = False,
    report: str | None = None,
) -> DataFrame:
    """Unfold the trips of a period into events; returns the events written, per kind.

    `ordered` puts all events in the order of time: trips go to the slices of
    time that they have events in, and unfold there. `report` names a
    folder for the rows that each file has, that were taken from it and that
    were lost with unreadable parts of it. Events are counted as they are
    written; for `report`, what was written is read once more. Of a file that
    cannot be decoded in parts, the row groups that can be are taken.
    A trip whose times lie too far apart to count steps between is reported
    as UNCOUNTABLE; it has no events on the way.
    """
    footers = identified_footers(spark, source, start, end)
    trips, seen = read_whole_groups(footers, step_us)
    long_trip = events.LONG_TRIP if seen.most_ticks > events.LONG_TRIP else None
    amounts = events.wire_amounts(spread(trips))
    located = zones.locate_trips(amounts, read_zones(spark, zone_file))
    if ordered:
        unfolded = events_in_time_order(located, step_us)
    else:
        unfolded = events.expand_events(located, step_us, long_trip=long_trip)
    timeline = events.with_positions(unfolded)
    scheduled = events.replay_schedule(timeline, seen.first_event_us, speed, slice_us)
    times = [c for c in ("replay_offset_us", "replay_slice") if c in scheduled.columns]
    messages = events.event_payload(
        scheduled, keep=(TRIP_ID, "event", "event_seq", "event_time_us", *times, SOURCE_FILE)
    )
    counted = Observation()
    kinds = [F.count_if(F.col("event") == kind).alias(kind) for kind in KINDS]
    observed = messages.observe(counted, F.count("*").alias("sent"), *kinds)
    observed.write.mode("overwrite").option("compression", "zstd").parquet(target)
    if report:
        written = spark.read.schema(messages.schema).parquet(target)
        write_csv(fl.ingested_rows(footers, EXPAND_NEEDS, taken_rows(written)).orderBy("path"), report)
    return written_counts(spark, counted.get, seen.n_uncountable)


def read_whole_groups(footers: DataFrame, step_us: int = STEP_US) -> tuple[DataFrame, Row]:
    """Typed trips of all row groups that can be decoded, and their `trip_statistics`.

    One pass over the wanted columns says of which files rows are missing. These
    are read in splits no larger than their smallest row group, so that a bad
    one takes no other with it.
    """

    def read(split_bytes: int | None = None, paths: DataFrame | None = None, but: DataFrame | None = None) -> DataFrame:
        own = footers if paths is None else footers.join(paths, "path", "left_semi")
        own = own if but is None else own.join(but, "path", "left_anti")
        return read_identified(own, split_bytes)

    trips = read()

    def counted(rows: DataFrame) -> DataFrame:
        found = events.read_statistics(rows, SOURCE_FILE, step_us)
        return found.withColumn("path", fl.listed_path(F.col("path")))

    per_file = store(counted(trips), "read-files")
    usable = footers.join(fl.missing_columns(footers, EXPAND_NEEDS), "path", "left_anti")
    short = store(fl.short_files(usable, per_file), "short-files")
    few = short.agg(F.count("*").alias("n"), F.min("group_bytes").alias("bytes")).first()
    if few.n:
        again = read(few.bytes, paths=short)
        rest = store(usable.join(short, "path", "left_anti"), "whole-files")
        trips = again if rest.isEmpty() else read(but=short).unionByName(again)
        sound = per_file.join(short, "path", "left_anti")
        per_file = sound.unionByName(counted(again))
    seen = per_file.agg(
        F.coalesce(F.max("most_ticks"), F.lit(0)).alias("most_ticks"),
        F.min("first_event_us").alias("first_event_us"),
        F.coalesce(F.sum("n_uncountable"), F.lit(0)).alias("n_uncountable"),
    )
    return trips, seen.first()


def taken_rows(written: DataFrame) -> DataFrame:
    """Trips per source file among written events: path, n_taken."""
    trips = written.where(F.col("event") == "PICKUP")
    counted = trips.groupBy(F.col(SOURCE_FILE).alias("path")).agg(F.count("*").alias("n_taken"))
    return counted.withColumn("path", fl.listed_path(F.col("path")))


def written_counts(spark: SparkSession, counted: dict[str, int], n_uncountable: int = 0) -> DataFrame:
    """Written events of each kind and, as `sent`, of all kinds; and trips that couldn't be counted."""
    rows = [(kind, counted[kind]) for kind in (*KINDS, "sent")]
    if n_uncountable:
        rows.append(("UNCOUNTABLE", n_uncountable))
    return spark.createDataFrame(rows, "event string, n_events bigint")


def identified_footers(
    spark: SparkSession, source: str, start: tuple[int, int], end: tuple[int, int]
) -> DataFrame:
    """Footers of the files of a period, in `year=`/`month=` folders or labelled by name."""
    files = fl.with_folder_period(fl.list_files(spark, source))
    within = fl.in_period_range(files, start, end)
    return store(fl.read_footers(within, skip_unreadable=True), "footers")


def read_identified(footers: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """Typed trips; files that lack an id or a time, or cannot be read, are left out."""
    usable = footers.join(fl.missing_columns(footers, EXPAND_NEEDS), "path", "left_anti")
    columns = [f.name for f in TRIP_SCHEMA.fields] + [TRIP_ID]

    def typed(raw: DataFrame) -> DataFrame:
        return events.with_defaults(raw, keep=(SOURCE_FILE,))

    return read_files(usable, columns, typed, skip_unreadable=True, split_bytes=split_bytes)


def check_times_job(
    spark: SparkSession, source: str, target: str, start: tuple[int, int], end: tuple[int, int]
) -> DataFrame:
    """Report, per file and time column, a sample and how many times are plausible."""

    def times(raw: DataFrame) -> DataFrame:
        kinds = dict(raw.dtypes)
        columns = [
            F.struct(F.lit(name).alias("column"), raw_epoch(F.col(name), kinds[name]).alias("raw"))
            for name in (PICKUP, DROPOFF)
        ]
        return raw.select(SOURCE_FILE, SOURCE_ROW, F.inline(F.array(*columns)))

    footers = identified_footers(spark, source, start, end)
    usable = footers.join(fl.missing_columns(footers, [PICKUP, DROPOFF]), "path", "left_anti")
    rows = read_files(usable, [PICKUP, DROPOFF], times, skip_unreadable=True)
    by = [SOURCE_FILE, "column"]
    sample = events.timestamp_sample(rows, "raw", by, [SOURCE_ROW])
    checked = sample.join(events.timestamp_check(rows, "raw", by), by).orderBy(*by)
    write_csv(checked, target)
    return checked


def raw_epoch(column: Column, kind: str) -> Column:
    """A whole number as it is stored, and any other time in microseconds."""
    return column.cast("bigint") if kind in ("bigint", "int") else epoch_micros(column, kind)


def profile_job(spark: SparkSession, source: str, target: str, manifest: str | None = None) -> DataFrame:
    """Write the count and schema reports of a folder of files; returns a one-row summary.

    `manifest` names a folder that keeps what footers say, so that the next
    profile opens only files that are new or have changed.
    """
    files = fl.list_files(spark, source)
    footers = store(fl.read_footers(files) if manifest is None else fl.known_footers(files, manifest), "footers")
    monthly = fl.file_counts(footers)
    schemas = fl.file_schemas(footers)
    n_files = footers.select("path").distinct().count()
    reports = {
        "monthly_counts": counts.with_change(monthly),
        "monthly_stats": counts.monthly_stats(monthly),
        "yearly_totals": counts.yearly_totals(monthly),
        "schema_mismatches": drift.schema_diff(schemas).orderBy("file"),
        "schema_baseline": drift.baseline(schemas),
        "schema_column_summary": drift.column_summary(schemas, n_files),
    }
    for name, report in reports.items():
        write_csv(report, f"{target}/{name}")
    return counts.coverage(monthly).select(
        counts.grand_total(monthly).scalar().alias("total_rows"),
        F.lit(n_files).alias("n_files"),
        "first_month",
        "last_month",
        drift.mismatch_count(schemas).scalar().alias("n_mismatches"),
    )


def feed_job(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    servers: str | None = None,
    event_files: bool = False,
    once: bool = False,
    from_topic: str | None = None,
    batch_files: int | None = None,
    batch_bytes: int = feed.BATCH_BYTES,
    batch_messages: int = feed.BATCH_MESSAGES,
    preview: bool = False,
) -> StreamingQuery:
    """Publish arriving messages to a topic or else, as Parquet, to `output`/messages.

    They come as lines of text files or, with `event_files`, as files of the
    expand job; with `from_topic`, from that topic of the servers that `source`
    names. A batch takes at most `batch_bytes` of files, or `batch_files` of them
    if that is given, and one file at least; from a topic at most
    `batch_messages` messages. `preview` also prints a few messages of each batch.
    """
    if from_topic:
        stream = feed.read_kafka_feed(spark, source, from_topic, batch_messages)
    else:
        read = feed.read_event_feed if event_files else feed.read_text_feed
        stream = read(spark, source, batch_files, batch_bytes)
    sink = feed.kafka_sink(servers) if servers else feed.parquet_sink(f"{output}/messages")
    if preview:
        sink = feed.both_sinks(sink, feed.console_preview())
    trigger = {"availableNow": True} if once else None
    return feed.start_feed(stream, sink, output, checkpoint, trigger=trigger)


def year_month(text: str) -> tuple[int, int]:
    year, month = text.strip().split("-")
    if not 1 <= int(month) <= 12:
        raise argparse.ArgumentTypeError(f"no such month: {text}")
    return int(year), int(month)


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripweave")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        return sub

    sub = job("clean", "source", "target")
    sub.add_argument("--start", type=year_month, default=CLEAN_START)
    sub.add_argument("--end", type=year_month, default=CLEAN_END)
    sub.add_argument("--report")
    job("identify", "source", "target")
    job("locate", "source", "target").add_argument("--include-unknown", action="store_true")
    sub = job("expand", "source", "zone_file", "target")
    sub.add_argument("--start", type=year_month, default=EXPAND_START)
    sub.add_argument("--end", type=year_month, default=EXPAND_END)
    sub.add_argument("--speed", type=float, default=PLAYBACK_SPEED)
    sub.add_argument("--ordered", action="store_true")
    sub.add_argument("--report")
    sub.add_argument("--step-us", type=int, default=STEP_US)
    sub.add_argument("--slice-us", type=int)
    sub = job("check-times", "source", "target")
    sub.add_argument("--start", type=year_month, default=EXPAND_START)
    sub.add_argument("--end", type=year_month, default=EXPAND_END)
    job("profile", "source", "target").add_argument("--manifest")
    sub = job("feed", "source", "output", "checkpoint")
    sub.add_argument("--servers")
    sub.add_argument("--event-files", action="store_true")
    sub.add_argument("--once", action="store_true")
    sub.add_argument("--from-topic")
    sub.add_argument("--batch-files", type=int)
    sub.add_argument("--batch-bytes", type=int, default=feed.BATCH_BYTES)
    sub.add_argument("--batch-messages", type=int, default=feed.BATCH_MESSAGES)
    sub.add_argument("--preview", action="store_true")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = vars(parse_arguments(arguments))
    run = {
        "clean": clean_job,
        "identify": identify_job,
        "locate": locate_job,
        "expand": expand_job,
        "check-times": check_times_job,
        "profile": profile_job,
        "feed": feed_job,
    }[options.pop("job")]
    result = run(build_session(), **options)
    if isinstance(result, DataFrame):
        rows = result.count()
        result.show(SHOWN_ROWS, truncate=False)
        if rows > SHOWN_ROWS:
            print(f"and {rows - SHOWN_ROWS} more of {rows} rows")
    elif isinstance(result, StreamingQuery):
        result.awaitTermination()
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main()
