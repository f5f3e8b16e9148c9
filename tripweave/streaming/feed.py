"""Decode JSON events, set broken ones aside, publish the rest keyed by trip."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery, StreamingQueryListener

from tripweave.functions.text import message_key
from tripweave.operators.numbering import running_totals
from tripweave.schema import EVENT_SCHEMA, TRIP_ID

# Fixed values of the publishing side.
KAFKA_SETTINGS = {
    "kafka.acks": "1",
    "kafka.retries": "3",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "32768",
    "kafka.compression.type": "lz4",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.buffer.memory": "67108864",
    "kafka.max.block.ms": "5000",
    "kafka.request.timeout.ms": "5000",
    "kafka.delivery.timeout.ms": "10000",
    "kafka.connections.max.idle.ms": "60000",
    "kafka.metadata.max.age.ms": "5000",
}
TOPIC = "taxi-event-data"
RETRIES = 3
FIRST_WAIT_SECONDS = 0.1
LONGEST_WAIT_SECONDS = 2.0
TRIGGER = "50 milliseconds"

# What one batch takes at most, so that a backlog comes in many batches.
BATCH_BYTES = 256 << 20
BATCH_MESSAGES = 1_000_000

# Fixed values of the publishing side: a batch from a topic waits for so many
# messages, but no longer than so.
LEAST_MESSAGES = 500
LONGEST_DELAY = "50ms"

# Messages of a batch that a preview prints.
PREVIEW_MESSAGES = 20

# Time between reports of a running feed.
REPORT_SECONDS = 10.0

# Batches whose counters share a folder.
BATCHES_A_FOLDER = 1000

# Name of what a running feed observes of its batches.
OBSERVED = "feed"
METRICS_SCHEMA = "batch_id bigint, received bigint, processed bigint, failed bigint"

Sink = Callable[[DataFrame, int], None]


def decode_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the event's 21 fields and `problem`, which is null for a good message.

    A message is parsed once. A number in quotes or a fraction where a whole
    number belongs is converted and not lost; a number where text belongs is
    written in plain form. Unknown fields are ignored. Of a field that comes
    twice the last counts in a session with the library's settings; elsewhere
    such a message is not JSON.
    """
    kinds = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA.fields}
    # JSON that begins like an object is one.
    parsed = df.withColumn("_json", F.when(F.ltrim(F.col(value)).startswith("{"), F.try_parse_json(value)))
    # All fields are taken in one walk over the object; one by one, each would look through its keys.
    texts_of = "struct<" + ", ".join(f"{n}: string" for n in kinds) + ">"
    parsed = parsed.withColumn("_fields", F.try_variant_get("_json", "$", texts_of))
    fields = {n: F.col(f"_fields.{n}") for n, k in kinds.items() if k == "string"}
    # Numbers are worked on as lists, which keeps the compiled code small.
    wrong = []
    for kind, to_numbers in (("bigint", whole_numbers), ("double", decimal_numbers)):
        names = [n for n, k in kinds.items() if k == kind]
        texts, numbers = f"_text_{kind}", f"_{kind}"
        parsed = parsed.withColumn(texts, F.array(*[F.col(f"_fields.{n}") for n in names]))
        parsed = parsed.withColumn(numbers, to_numbers(F.col(texts)))
        fields.update({n: F.get(numbers, F.lit(i)) for i, n in enumerate(names)})
        wrong.append(F.filter(F.array(*[F.lit(n) for n in names]), is_lost(F.col(texts), F.col(numbers))))
    parsed = parsed.withColumn("_wrong", F.concat_ws(",", *wrong))
    problem = F.when(F.col("_json").isNull(), "not JSON").when(
        F.col("_wrong") != "", F.concat(F.lit("wrong type: "), F.col("_wrong"))
    )
    # A filter is not moved below a generator, so a message is parsed once even
    # when only the good or only the bad ones are wanted.
    decoded = F.struct(*[fields[n].alias(n) for n in kinds], problem.alias("problem"))
    return parsed.select(*df.columns, F.inline(F.array(decoded)))


def whole_numbers(texts: Column) -> Column:
    return F.transform(texts, lambda text: F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")))


def decimal_numbers(texts: Column) -> Column:
    return texts.try_cast("array<double>")


def is_lost(texts: Column, numbers: Column) -> Callable[[Column, Column], Column]:
    """Whether the text at a place of one list is not blank and has no number in the other."""

    def lost(_: Column, at: Column) -> Column:
        return F.get(numbers, at).isNull() & F.coalesce(F.trim(F.get(texts, at)) != "", F.lit(False))

    return lost


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("problem").isNull()).drop("problem")


def dead_letters(decoded: DataFrame, value: str = "value") -> DataFrame:
    """The messages that could not be decoded, with the reason."""
    return decoded.where(F.col("problem").isNotNull()).select(value, "problem")


def to_messages(events: DataFrame, keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """(key, value): the trip id as text and all 21 fields as JSON, nulls included.

    Equal keys keep the events of a trip in one partition of a topic.
    """
    body = F.struct(*[F.col(f.name) for f in EVENT_SCHEMA.fields])
    return events.select(
        *keep,
        message_key(F.col(TRIP_ID)).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def counters() -> list[Column]:
    """Messages received, processed and failed."""
    return [
        F.count("*").alias("received"),
        F.count_if(F.col("problem").isNull()).alias("processed"),
        F.count_if(F.col("problem").isNotNull()).alias("failed"),
    ]


def batch_metrics(decoded: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Messages received, processed and failed in a set of decoded messages, or per group."""
    return decoded.groupBy(*(by or [])).agg(*counters())


def success(received: Column, processed: Column) -> tuple[Column, Column]:
    """(percentage, its text); null and "N/A" before anything is received."""
    percent = F.try_divide(processed * 100.0, received.cast("double"))
    text = F.when(received > 0, F.format_string("%.2f%%", percent)).otherwise("N/A")
    return percent, text


def feed_metrics(batches: DataFrame) -> DataFrame:
    """Counters since the start of the feed, from one row per batch."""
    totals = batches.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("received", "processed", "failed")
        ],
        F.count("*").alias("batches"),
    )
    percent, text = success(F.col("received"), F.col("processed"))
    return totals.withColumns({"success_pct": percent, "success_rate": text})


def feed_history(batches: DataFrame) -> DataFrame:
    """The counters as they stood after each batch."""
    names = {n: f"total_{n}" for n in ("received", "processed", "failed")}
    history = running_totals(batches, "batch_id", names)
    percent, text = success(F.col("total_received"), F.col("total_processed"))
    return history.withColumns({"success_pct": percent, "success_rate": text})


def read_text_feed(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = BATCH_BYTES
) -> DataFrame:
    """A stream of messages, one per line of the text files that appear in a folder."""
    return limited(spark.readStream.format("text"), files_per_batch, bytes_per_batch).load(path)


def read_event_feed(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = BATCH_BYTES
) -> DataFrame:
    """A stream of messages from the event files the expand job writes."""
    return limited(spark.readStream.schema("value string"), files_per_batch, bytes_per_batch).parquet(path)


def limited(reader: DataStreamReader, files_per_batch: int | None, bytes_per_batch: int | None) -> DataStreamReader:
    """A reader of files that takes so many files a batch or else so many bytes of them, one file at least."""
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else reader


def topic_options(
    messages_per_batch: int | None = None,
    least_messages: int | None = LEAST_MESSAGES,
    longest_delay: str = LONGEST_DELAY,
) -> dict[str, str]:
    """A batch takes at most `messages_per_batch` and waits for `least_messages`, but no longer than `longest_delay`."""
    options = {}
    if messages_per_batch:
        options["maxOffsetsPerTrigger"] = str(messages_per_batch)
    if least_messages:
        options |= {"minOffsetsPerTrigger": str(least_messages), "maxTriggerDelay": longest_delay}
    return options


def read_kafka_feed(
    spark: SparkSession, servers: str, topic: str = TOPIC, messages_per_batch: int | None = None
) -> DataFrame:
    """A stream of message values from a topic; needs Spark's Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).options(**topic_options(messages_per_batch))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def kafka_sink(servers: str, topic: str = TOPIC) -> Sink:
    """Publish (key, value) rows to a topic; needs Spark's Kafka package."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .options(**KAFKA_SETTINGS)
            .save()
        )

    return publish


def parquet_sink(path: str) -> Sink:
    """One folder per batch; a batch that runs again replaces its own rows."""

    def write(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def console_preview(rows: int = PREVIEW_MESSAGES) -> Sink:
    """Print a few messages of a batch and say how many it leaves out; publishes nothing."""

    def show(messages: DataFrame, batch_id: int) -> None:
        messages.show(rows, truncate=False)
        total = messages.count()
        print(f"batch {batch_id}: {min(rows, total)} of {total} messages shown")

    return show


def both_sinks(*sinks: Sink) -> Sink:
    def send(messages: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(messages, batch_id)

    return send


def with_retry(sink: Sink, retries: int = RETRIES) -> Sink:
    """Send a whole batch again when sending fails, waiting longer each time.

    Rows sent before the failure may arrive twice.
    """

    def send(messages: DataFrame, batch_id: int) -> None:
        wait = FIRST_WAIT_SECONDS
        for attempt in range(retries + 1):
            try:
                return sink(messages, batch_id)
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait)
                wait = min(wait * 2, LONGEST_WAIT_SECONDS)

    return send


def start_feed(
    stream: DataFrame,
    sink: Sink,
    output: str,
    checkpoint: str,
    value: str = "value",
    trigger: dict | None = None,
    report_seconds: float = REPORT_SECONDS,
) -> StreamingQuery:
    """Run the feed: publish good messages, set broken ones aside, record the counts.

    `output` receives `dead_letters/`, a folder per batch that has any, and
    `metrics/`, a folder per thousand batches with a file for each, so a batch
    that is run again after a failure is counted once. The totals are printed
    every `report_seconds`; they begin with the batches that earlier runs
    recorded in `output`.
    """
    spark = stream.sparkSession
    publish = with_retry(sink)
    set_aside = parquet_sink(f"{output}/dead_letters")
    # So that there are folders to read while no message is broken, or none has come.
    set_aside(spark.createDataFrame([], f"`{value}` string, problem string"), -1)
    spark.createDataFrame([], METRICS_SCHEMA).write.mode("append").parquet(f"{output}/metrics/group=0")

    original = F.when(F.col("problem").isNotNull(), F.col(value)).alias("original")
    decoded = decode_events(stream, value).observe(OBSERVED, *counters())

    def process(batch: DataFrame, batch_id: int) -> None:
        # Three outputs of one decoding; only what they need is kept meanwhile.
        ready = to_messages(batch, keep=("problem", original)).persist()
        try:
            publish(good_events(ready).select("key", "value"), batch_id)
            counted = batch_metrics(ready).first()
            broken = ready.select(F.col("original").alias(value), "problem")
            if counted.failed:
                set_aside(dead_letters(broken, value), batch_id)
            record_metrics(batch.sparkSession, output, batch_id, counted)
        finally:
            ready.unpersist()

    # What is recorded already may run once more, if its end wasn't noted down.
    recorded = read_metrics(spark, output)
    last = recorded.agg(F.max("batch_id")).first()[0]
    totals = FeedTotals(report_seconds, feed_metrics(recorded).first(), -1 if last is None else last)
    writer = decoded.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    name = f"feed-{uuid.uuid4().hex}"
    spark.streams.addListener(FeedListener(spark, name, totals))
    return writer.queryName(name).trigger(**(trigger or {"processingTime": TRIGGER})).start()


class FeedTotals:
    """Counters of all batches so far, printed now and then."""

    def __init__(self, every: float = REPORT_SECONDS, before: Row | None = None, last_batch: int = -1):
        self.every, self.last, self.last_batch = every, time.monotonic(), last_batch
        names = ("received", "processed", "failed", "batches")
        self.received, self.processed, self.failed, self.batches = (before[n] if before else 0 for n in names)

    def add(self, counted: Row, batch_id: int | None = None) -> None:
        """Count a batch, unless it is one of those that were counted before."""
        if batch_id is None or batch_id > self.last_batch:
            self.received += counted["received"]
            self.processed += counted["processed"]
            self.failed += counted["failed"]
            self.batches += 1
            self.last_batch = self.last_batch if batch_id is None else batch_id
        if time.monotonic() - self.last >= self.every:
            self.report()

    def report(self) -> None:
        self.last = time.monotonic()
        print(self.text(), flush=True)

    def text(self) -> str:
        share = f"{self.processed * 100 / self.received:.2f}%" if self.received else "N/A"
        return (
            f"received {self.received}, processed {self.processed}, failed {self.failed}, "
            f"batches {self.batches}, success {share}"
        )


class FeedListener(StreamingQueryListener):
    """Adds what a query observed of each batch to the totals; reports them, also while nothing comes and at the end."""

    def __init__(self, spark: SparkSession, name: str, totals: FeedTotals):
        self.spark, self.name, self.totals, self.run = spark, name, totals, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if event.progress.name == self.name and seen is not None:
            self.totals.add(seen, event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        if event.runId == self.run and time.monotonic() - self.totals.last >= self.totals.every:
            self.totals.report()

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.totals.report()
            self.spark.streams.removeListener(self)


def record_metrics(spark: SparkSession, output: str, batch_id: int, counted: Row) -> None:
    """Append a batch's counters to its folder of a thousand; a repeated batch adds an equal row."""
    row = (batch_id, counted.received, counted.processed, counted.failed)
    folder = f"{output}/metrics/group={batch_id // BATCHES_A_FOLDER}"
    spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def read_metrics(spark: SparkSession, output: str) -> DataFrame:
    """One row per batch; of a batch that ran again, the row of either run."""
    written = spark.read.schema(METRICS_SCHEMA).parquet(f"{output}/metrics")
    return written.drop("group").dropDuplicates(["batch_id"])


def read_dead_letters(spark: SparkSession, output: str, value: str = "value") -> DataFrame:
    schema = f"`{value}` string, problem string, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{output}/dead_letters")
