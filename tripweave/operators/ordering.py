"""Events in global time order, by moving trips and not their events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.times import whole_div
from tripweave.operators.events import CHUNK, event_times, tick_count
from tripweave.operators.numbering import TASK_ROWS, join_pieces, partitions_for
from tripweave.schema import STEP_US, TRIP_ID

# Time is cut into slices of an hour, or of so many steps if those take longer.
SLICE_US = 3_600_000_000
SLICE_STEPS = 64


def slice_of(us: Column, width: int) -> Column:
    """Number of the slice that holds a time; also right before 1970."""
    return whole_div(us, width) - F.when(us % width < 0, 1).otherwise(0)


def slice_pieces(
    trips: DataFrame,
    step_us: int = STEP_US,
    width: int = SLICE_US,
    pickup_us: str = "pickup_us",
    dropoff_us: str = "dropoff_us",
    chunk: int = CHUNK,
) -> DataFrame:
    """Trips with a row for each slice that holds some of their events.

    Adds `_slice`, and `_from` and `_to`, the event_seq of the first and last
    event in it; a slice is at least a step wide. A trip that ends before it
    starts, or too late to count its steps, has its two ends only. A wrong time
    that makes a trip span very many slices is unfolded in chunks.
    """
    pickup, dropoff = F.col(pickup_us), F.col(dropoff_us)
    ticks = tick_count(pickup, dropoff, step_us)
    counted = trips.withColumns({"_ticks": ticks, "_begin": slice_of(pickup, width), "_end": slice_of(dropoff, width)})
    moves, begin, end = F.col("_ticks") > 0, F.col("_begin"), F.col("_end")
    span = F.when(moves, end - begin).otherwise(0)
    counted = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), whole_div(span, chunk))))
    low = begin + F.col("_chunk") * chunk
    slices = F.when(moves, F.sequence(low, F.least(low + (chunk - 1), end))).otherwise(F.array_distinct(F.array(begin, end)))
    pieces = counted.withColumn("_slice", F.explode(slices))
    here, final = F.col("_slice"), F.col("_ticks") + 1
    # Times within the trip, so that nothing is beyond what its own times can say.
    first = F.when(here == begin, 0).when(moves, whole_div(here * width - pickup - 1, step_us) + 1).otherwise(1)
    last = F.when(here == end, final).when(moves, whole_div((here + 1) * width - 1 - pickup, step_us)).otherwise(0)
    return pieces.withColumns({"_from": first, "_to": last}).drop("_ticks", "_begin", "_end", "_chunk")


def events_in_time_order(
    trips: DataFrame,
    step_us: int = STEP_US,
    pickup_us: str = "pickup_us",
    dropoff_us: str = "dropoff_us",
    slice_events: int = TASK_ROWS,
    width: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The events of `expand_events`, ordered by time, then trip, then position in the trip.

    Time is cut into slices. A trip goes to the slices that it has events in,
    by range, and unfolds there, each piece into the events of its slice; a
    task then sorts what it has. So rows that move are trips, little more than
    once each. Events per slice are counted first, from the trips' two times.
    Those of a slice with more than `slice_events` are unfolded before they
    move, and spread by time, trip and position, so that even a single instant
    that has a large part of all events falls into many tasks.
    """
    width = width or max(SLICE_US, SLICE_STEPS * step_us)
    if width < step_us:
        raise ValueError("a slice must be as wide as a step")
    pieces = slice_pieces(trips, step_us, width, pickup_us, dropoff_us, chunk)
    counts = pieces.groupBy("_slice").agg(F.sum(F.col("_to") - F.col("_from") + 1).alias("_events"))
    total, most = counts.agg(F.sum("_events"), F.max("_events")).first()
    spark = trips.sparkSession
    partitions = partitions_for(total or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = ["_slice"]
    if (most or 0) > slice_events:
        # At most events / slice_events of these.
        hot = counts.where(F.col("_events") > slice_events).select("_slice")
        pieces = join_pieces(pieces.withColumn("_row", F.monotonically_increasing_id()), hot, ["_slice"], "_hot")
        numbers = F.when(F.col("_hot"), F.sequence("_from", "_to")).otherwise(F.array("_from"))
        single = F.col("_hot") & F.col("_one").isNotNull()
        time = event_times(F.col("_one"), tick_count(F.col(pickup_us), F.col(dropoff_us), step_us) + 1, step_us, pickup_us, dropoff_us)
        pieces = pieces.withColumn("_one", F.explode(numbers)).withColumns(
            {
                "_time": F.when(single, time),
                "_trip": F.when(single, F.col(TRIP_ID)),
                "_seq": F.when(single, F.col("_one")),
                # Events equal in all of that may be ordered in any way.
                "_tie": F.when(single, F.col("_row")),
                "_from": F.col("_one"),
                "_to": F.when(single, F.col("_one")).otherwise(F.col("_to")),
            }
        )
        keys += ["_time", "_trip", "_seq", "_tie"]
    placed = pieces.repartitionByRange(partitions, *keys)
    final = tick_count(F.col(pickup_us), F.col(dropoff_us), step_us) + 1
    seq = F.col("event_seq")
    kind = F.when(seq == 0, "PICKUP").when(seq == final, "DROPOFF").otherwise("IN_TRANSIT")
    events = placed.withColumn("event_seq", F.explode(F.sequence("_from", "_to"))).withColumns(
        {"event": kind, "event_time_us": event_times(seq, final, step_us, pickup_us, dropoff_us)}
    )
    unfolded = events.select(*trips.columns, "event_seq", "event", "event_time_us")
    return unfolded.sortWithinPartitions("event_time_us", TRIP_ID, "event_seq")
