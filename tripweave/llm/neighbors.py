"""Nearest vectors by a permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.llm.workers import bound_batches, find_library
from tripweave.session import new_folder, store

# Pivots; a place in an order of them fits a byte.
PIVOTS = 256

# Files that a vector is posted in, and that a query reads: those of its nearest pivots.
POSTED = 16
READ = 24

# Share of a shard that is measured for a query, the candidates of least footrule distance,
# and the fewest, as a multiple of k, where a shard is small.
RERANKED = 0.05
LEAST_RERANKED = 20

# Vectors of a shard, which has its own files.
SHARD_ROWS = 8192

# Queries that are searched for in one pass over the index.
PASS_QUERIES = 4096

FOUND = "query_id long, vec_id long, score double"

# A pivot that isn't there: it never moves and nothing is posted for it.
NO_PLACE = 255

_BYTES = np.uint64(0x00FF00FF00FF00FF)
_ONES = np.uint64(0x0001000100010001)


def usable(vector: str = "embedding") -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


@dataclass
class PermutationIndex:
    """Orders pivots by nearness; holds no vectors of the corpus."""

    pivots: np.ndarray

    def orders(self, vectors: np.ndarray) -> np.ndarray:
        """All pivots for each vector, nearest first; of equal ones the earlier."""
        square = (vectors**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)
        return np.argsort(square - 2 * vectors @ self.pivots.T, axis=1, kind="stable")

    def places(self, orders: np.ndarray) -> np.ndarray:
        """Each pivot's place in each order, 0 for the nearest."""
        found = np.full((len(orders), PIVOTS), NO_PLACE, np.uint8)
        ranks = np.broadcast_to(np.arange(orders.shape[1], dtype=np.uint8), orders.shape)
        np.put_along_axis(found, orders, ranks, axis=1)
        return found


def footrule(places: np.ndarray, one: np.ndarray) -> np.ndarray:
    """How far all pivots together move between each row of places and `one`.

    Bytes are summed in four lanes of a 64-bit word; 256 moves of at most 255 fit a lane.
    """
    moved = (np.maximum(places, one) - np.minimum(places, one)).view(np.uint64)
    lanes = ((moved & _BYTES) + (moved >> np.uint64(8) & _BYTES)).sum(axis=1)
    return lanes * _ONES >> np.uint64(48)


class Shard:
    """Some vectors and their inverted files: of each pivot, the rows that it is among the nearest pivots of."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray):
        self.ids, self.vectors, self.places = ids, vectors, places
        pivot, row = np.nonzero((places < POSTED).T)
        self.files = np.split(row, np.searchsorted(pivot, np.arange(1, PIVOTS)))

    def search(self, query_id: int, query: np.ndarray, order: np.ndarray, places: np.ndarray, k: int, reranked: float):
        """The k nearest rows found, and their distances."""
        seen = np.zeros(len(self.ids), bool)
        for pivot in order[:READ]:
            seen[self.files[pivot]] = True
        seen &= self.ids != query_id
        rows = np.flatnonzero(seen)
        most = max(LEAST_RERANKED * k, int(np.ceil(reranked * len(self.ids))))
        if len(rows) > most:
            moved = footrule(self.places[rows], places)
            rows = rows[moved <= np.partition(moved, most - 1)[most - 1]]
        distance = np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], distance))[:k]
        return rows[best], distance[best]


def fit_index(vectors: DataFrame, pivots: int = PIVOTS) -> PermutationIndex | None:
    """Pivots drawn from distinct vectors by a hash of their ids; a bounded sample of 4 a pivot, 256 pivots at most."""
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(4 * pivots).select("embedding").collect()
    if not drawn:
        return None
    distinct = np.array(list(dict.fromkeys(tuple(row.embedding) for row in drawn)), np.float64)
    return PermutationIndex(distinct[: min(pivots, PIVOTS)])


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, reranked: float = RERANKED) -> DataFrame:
    """The k nearest vectors, by Euclidean distance, of each row that `is_query` picks.

    `embeddings` has vec_id and embedding. Vectors that are null, empty, zero
    or hold null or non-finite components take no part, nor do rows without
    vec_id and vectors of another length than the most common. Of several
    query rows with one vec_id the smallest vector is the query; candidates
    with one vec_id are one, at the least distance. A query's own vec_id is
    no candidate. Returns query_id, rank (from 1; equal distances by vec_id),
    vec_id and score, the distance in double precision.

    A permutation index: each vector's order of the pivots is found once and
    stored beside it. Up to 8,192 rows of a partition in turn are a shard, whatever
    the batches they come in, with files of their own: one per pivot, of the
    vectors that it is among the 16 nearest pivots of. A query reads the files
    of its 24 nearest pivots; what it finds there is ranked by footrule distance
    of the whole orders, and the best `reranked` of the shard, or 20 k if that
    is more, are measured, those tied with the last one included. So no vector
    moves, whatever pivot is common; queries come in blocks of 4,096, each a
    pass over the stored index whose few results are written to the work folder.
    """
    spark = bound_batches(find_library(embeddings.sparkSession))
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    sound = embeddings.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"),
        F.col("embedding") if single else F.col("embedding").cast("array<double>"),
        is_query.alias("is_query"),
    )
    sizes = sound.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    sound = sound.where(F.size("embedding") == (sizes.n if sizes else 0))
    pivots = fit_index(sound)
    queries = sound.where("is_query").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    passes = -(-queries.count() // PASS_QUERIES)
    if pivots is None or not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = store_index(sound, pivots)
    path = new_folder(spark, "nearest")
    for i in range(passes):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == i).collect()
        index.mapInArrow(_searched(pivots, block, k, reranked), FOUND).write.mode("append").parquet(path)
    best = spark.read.schema(FOUND).parquet(path).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def store_index(vectors: DataFrame, pivots: PermutationIndex) -> DataFrame:
    """`vectors` (vec_id, embedding) with the places of the pivots in each one's order, written to the work folder."""

    def permuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD_ROWS):
                part = batch.slice(start, SHARD_ROWS)
                places = pivots.places(pivots.orders(as_matrix(part.column(1))))
                held = pa.array([row.tobytes() for row in places], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), held], names=["vec_id", "embedding", "places"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding").mapInArrow(permuted, f"vec_id long, embedding {kind}, places binary")
    return store(rows, "permutations")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a partition, `SHARD_ROWS` at a time."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SHARD_ROWS - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == SHARD_ROWS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(index: PermutationIndex, block: list, k: int, reranked: float):
    query_ids = np.array([row.vec_id for row in block], np.int64)
    queries = np.array([row.embedding for row in block], np.float64)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(query_ids):
            return
        orders = index.orders(queries)
        places = index.places(orders)
        for rows in _chunks(batches):
            ids = rows.column(0).to_numpy()
            posted = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(-1, PIVOTS)
            shard = Shard(ids, as_matrix(rows.column(1).chunk(0)), posted)
            for i, query in enumerate(query_ids.tolist()):
                row, score = shard.search(query, queries[i], orders[i], places[i], k, reranked)
                if len(row):
                    found = [pa.array(np.full(len(row), query)), pa.array(ids[row]), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(found, names=["query_id", "vec_id", "score"])

    return shards
