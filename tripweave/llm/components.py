"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripweave.session import store


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of it and its neighbours."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        .where("a > b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(least, "a")
    moved = joined.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest id reachable from each id that has a link: node, component.

    `links` holds pairs a, b of ids, in any order, repeated or not; pairs with
    a null or of an id with itself count for nothing. Large-star and
    small-star steps alternate until only stars are left; each round is written
    to the work folder, and only whether it is the last comes to the driver.
    Smallest neighbours are found by aggregation, so a node with very many
    links needs no task of its own.
    """
    links = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    while not _are_stars(links):
        links = store(_small_star(_large_star(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _are_stars(links: DataFrame) -> bool:
    """Whether each node has one link to a smaller one, which has none itself."""
    ends = F.array(*[F.struct(F.col(end).alias("node"), F.lit(up).alias("up")) for end, up in (("a", 1), ("b", 0))])
    nodes = links.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return nodes.where("up > 1 or (up = 1 and n > up)").isEmpty()
