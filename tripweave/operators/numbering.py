"""Row positions and running totals that hold up when one group is very large."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows a task should get when a large input is shuffled for numbering.
TASK_ROWS = 2_000_000

# Group pieces up to this number, about 100 bytes each, are copied to every executor.
BROADCAST_PIECES = 500_000

# Rows that share one task while summing up.
BLOCK = 10_000


def partitions_for(rows: int, at_least: int) -> int:
    """How many partitions a shuffle of `rows` rows needs."""
    return max(-(-rows // TASK_ROWS), at_least)


def number_in_buckets(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    instant: Column,
    tie_break: list[str],
    name: str,
    bucket_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the 1-based position of each row in its group, along `instant` and then `tie_break`.

    Groups are cut into buckets, `bucket` being a coarser form of `instant`;
    a bucket of more than `bucket_rows` rows is cut into its instants, and an
    instant of more into blocks of the first tie-break column, if that is a
    whole number. Rows are numbered within their piece, after the rows of the
    pieces before it. Pieces are counted first, over the narrow columns; there
    is one shuffle, by range of keys and pieces, so that a task holds
    neighbours, and nothing is stored. Null keys, instants and ties take part.
    """
    spark = df.sparkSession
    limit = max(1, bucket_rows)
    cut = df.withColumns({"_bucket": bucket, "_value": instant})
    at = [*keys, "_bucket"]
    counts = cut.groupBy(*at).agg(F.count("*").alias("_rows"))
    total, most = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    nothing = F.lit(None)
    cut = cut.withColumns({"_instant": nothing.cast("timestamp_ntz"), "_block": nothing.cast("bigint")})
    kind = dict(df.dtypes).get(tie_break[0], "") if tie_break else ""
    if (most or 0) > limit:
        # No more than rows / limit of these, and of the instants below.
        large = counts.where(F.col("_rows") > limit).drop("_rows")
        cut = join_pieces(cut.drop("_instant"), large, at, "_large")
        cut = cut.withColumn("_instant", F.when(F.col("_large"), F.col("_value"))).drop("_large")
        if kind in ("tinyint", "smallint", "int", "bigint"):
            at_instant = [*at, "_instant"]
            same = cut.groupBy(*at_instant).agg(F.count("*").alias("_rows"))
            cut = join_pieces(cut.drop("_block"), same.where(F.col("_rows") > limit).drop("_rows"), at_instant, "_large")
            block = F.floor(F.col(tie_break[0]) / limit)
            cut = cut.withColumn("_block", F.when(F.col("_large"), block)).drop("_large")
    piece = ["_bucket", "_instant", "_block"]
    order = [F.col(column).asc_nulls_last() for column in piece]
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pieces = cut.groupBy(*keys, *piece).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    pieces = pieces.select(*keys, *piece, before)
    partitions = partitions_for(total or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.repartitionByRange(partitions, *keys, *piece)
    inside = Window.partitionBy(*keys, *piece).orderBy(
        F.col("_value").asc(), *[F.col(column).asc_nulls_last() for column in tie_break]
    )
    numbered = cut.withColumn("_at", F.row_number().over(inside))
    shifted = join_pieces(numbered, pieces, [*keys, *piece])
    return shifted.select(*df.columns, (F.col("_at") + F.col("_before")).cast("bigint").alias(name))


def join_pieces(rows: DataFrame, pieces: DataFrame, on: list[str], mark: str | None = None) -> DataFrame:
    """Join to pieces with unique, possibly null, keys; copied to every executor if they are few.

    With `mark` a left join that says which rows found a piece.
    """
    named = pieces.withColumnsRenamed({column: f"_of_{column}" for column in on})
    if mark:
        named = named.withColumn(mark, F.lit(True))
    if named.limit(BROADCAST_PIECES + 1).count() <= BROADCAST_PIECES:
        named = F.broadcast(named)
    match = reduce(and_, (F.col(column).eqNullSafe(F.col(f"_of_{column}")) for column in on))
    joined = rows.join(named, match, "left" if mark else "inner")
    return joined.drop(*[f"_of_{column}" for column in on])


def running_totals(
    df: DataFrame, order: str, columns: dict[str, str], block: int = BLOCK
) -> DataFrame:
    """Add running sums of `columns` (source -> new name) along a whole-number column.

    Sums run inside blocks of the order column; only one row per block meets in
    a single task to carry the totals over.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = blocked.groupBy("_block").agg(
        *[F.sum(source).alias(f"_sum_{source}") for source in columns]
    )
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "_block",
        *[
            F.coalesce(F.sum(f"_sum_{source}").over(earlier), F.lit(0)).alias(f"_before_{source}")
            for source in columns
        ],
    )
    inside = Window.partitionBy("_block").orderBy(order)
    joined = blocked.join(totals, "_block")
    for source, name in columns.items():
        running = F.sum(source).over(inside) + F.col(f"_before_{source}")
        joined = joined.withColumn(name, running)
    return joined.select(*df.columns, *columns.values())
