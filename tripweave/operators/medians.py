"""Exact medians of very large groups: counts per range of values narrow the middle down."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of the first cells, in units of the values, and parts of a cell in the second round.
CELL = 1 / 65_536
PARTS = 65_536


def exact_medians(
    df: DataFrame, keys: list[str], values: dict[str, str], small: bool, cell: float = CELL, parts: int = PARTS
) -> DataFrame:
    """Median of each of `values` (source -> new name) in each group, nulls left out; null keys are a group.

    Values are counted per cell of `cell` width, with the least and greatest
    of each. The counts say which cell holds the middle rank; where that
    doesn't settle the value already, the cell is cut into `parts` parts and
    counted again, and then, within one part, value by value. Tasks combine
    their counts before any are moved, so a group may have any number of rows,
    all of them equal or not: no group is gathered, sorted or stored. With
    `small`, cells still open, one per group and value, are copied to every
    executor. Rounds that nothing is left for read nothing.
    """
    rows = F.array(*[F.struct(F.lit(i).alias("axis"), F.col(name).alias("value")) for i, name in enumerate(values)])
    points = df.select(*keys, F.inline(rows)).where(F.col("value").isNotNull())
    by = [*keys, "axis"]

    first = _middles(_counted(points, by, F.rint(F.col("value") / cell)), by)
    found = [_settled(first, by)]
    left = _still_open(points, first, by, F.rint(F.col("value") / cell), small)
    share = (F.col("value") - F.col("open_lo")) / (F.col("open_hi") - F.col("open_lo"))
    second = _middles(_counted(left, by, F.rint(share * parts), "open_low", "open_high"), by)
    found.append(_settled(second, by))
    left = _still_open(left.drop("open_cell"), second, by, F.rint(share * parts), small)
    third = _middles(_counted(left, by, F.col("value"), "open_low", "open_high"), by)
    found.append(_settled(third, by))

    middle = reduce(DataFrame.unionByName, found)
    named = [F.max(F.when(F.col("axis") == i, F.col("median"))).alias(name) for i, name in enumerate(values.values())]
    return middle.groupBy(*keys).agg(*named)


def _counted(points: DataFrame, by: list[str], cell: Column, *ranks: str) -> DataFrame:
    """Values per cell, with the least and greatest of them; `ranks` are those looked for, if known."""
    return points.withColumn("cell", cell).groupBy(*by, "cell").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), *[F.first(rank).alias(rank) for rank in ranks]
    )


def _middles(cells: DataFrame, by: list[str]) -> DataFrame:
    """Per group, the cells that hold its two middle ranks, and their values where the counts settle them.

    The ranks are those given, or the middle ones of all values of the group.
    """
    whole = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up_to = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    given = "open_low" in cells.columns
    total = F.sum("n").over(whole)
    low = F.col("open_low") if given else F.call_function("div", total + 1, F.lit(2))
    high = F.col("open_high") if given else F.call_function("div", total, F.lit(2)) + 1
    ranked = cells.withColumns({"low": low, "high": high, "before": F.sum("n").over(up_to) - F.col("n")})

    def held(rank: str) -> Column:
        place = F.col(rank) - F.col("before")
        value = F.when(place == 1, F.col("lo")).when((place == F.col("n")) | (F.col("lo") == F.col("hi")), F.col("hi"))
        inside = (place >= 1) & (place <= F.col("n"))
        return F.max(F.when(inside, F.struct("cell", "lo", "hi", place.alias("place"), value.alias("value")))).alias(rank)

    return ranked.groupBy(*by).agg(held("low"), held("high"))


def _is_settled() -> Column:
    return F.col("low.value").isNotNull() & F.col("high.value").isNotNull()


def _settled(middles: DataFrame, by: list[str]) -> DataFrame:
    low, high = F.col("low.value"), F.col("high.value")
    # Of equal ones no mean is taken, as their sum may be beyond a number's range.
    median = F.when(low == high, low).otherwise((low + high) / 2)
    return middles.where(_is_settled()).select(*by, median.alias("median"))


def _still_open(points: DataFrame, middles: DataFrame, by: list[str], cell: Column, small: bool) -> DataFrame:
    """The values in cells that hold both middle ranks and more, with the ranks within the cell."""
    cells = middles.where(~_is_settled()).select(
        *[F.col(name).alias(f"of_{name}") for name in by],
        F.col("low.cell").alias("of_cell"),
        F.col("low.lo").alias("of_lo"),
        F.col("low.hi").alias("of_hi"),
        F.col("low.place").alias("of_low"),
        F.col("high.place").alias("of_high"),
    )
    if small:
        cells = F.broadcast(cells)
    held = points.withColumn("open_cell", cell)
    names = ["lo", "hi", "low", "high"]
    match = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in by]
    joined = held.join(cells, reduce(and_, match, F.col("open_cell") == F.col("of_cell")))
    return joined.select(*by, "value", "open_cell", *[F.col(f"of_{name}").alias(f"open_{name}") for name in names])
