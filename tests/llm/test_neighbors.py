"""The permutation index: footrule distances, shards, blocks of queries and recall at a small share."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import neighbors
from tripweave.llm.neighbors import PIVOTS, PermutationIndex, footrule, nearest


def made(n, width=16, seed=4):
    random = np.random.RandomState(seed)
    return random.normal(size=(n, width)).astype(np.float32)


def frame(spark, data, parts=3):
    rows = [(i, row) for i, row in enumerate(data.tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)


@pytest.mark.parametrize("pivots", [1, 5, PIVOTS])
def test_footrule_is_the_sum_of_moves(pivots):
    data = made(400).astype(np.float64)
    index = PermutationIndex(data[:pivots])
    orders = index.orders(data)
    distance = np.sqrt(((data[:, None] - data[None, :pivots]) ** 2).sum(axis=2))
    assert (np.diff(np.take_along_axis(distance, orders, 1), axis=1) >= -1e-9).all()
    want = np.abs(np.argsort(orders, axis=1)[:, None].astype(int) - np.argsort(orders[:7], axis=1)[None]).sum(axis=2)
    places = index.places(orders)
    for i in range(7):
        assert footrule(places, places[i]).tolist() == want[:, i].tolist()


def test_footrule_at_its_greatest():
    up = np.arange(PIVOTS, dtype=np.uint8)[None]
    assert footrule(up, up[0, ::-1].copy()).tolist() == [PIVOTS**2 // 2]
    assert footrule(np.full((1, PIVOTS), 255, np.uint8), np.zeros(PIVOTS, np.uint8)).tolist() == [255 * 256]


def test_blocks_of_queries_and_batches_change_nothing(spark, monkeypatch):
    vectors = frame(spark, made(900)).sortWithinPartitions("vec_id")
    is_query = F.col("vec_id") % 100 == 0
    monkeypatch.setattr(neighbors, "SHARD_ROWS", 64)
    want = sorted(map(tuple, nearest(vectors, is_query, k=3).collect()))
    assert len(want) == 27
    monkeypatch.setattr(neighbors, "PASS_QUERIES", 2)
    assert sorted(map(tuple, nearest(vectors, is_query, k=3).collect())) == want
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sorted(map(tuple, nearest(vectors, is_query, k=3).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repeated_rows_and_equal_vectors(spark):
    data = made(300)
    data[100:150] = data[0]
    vectors = frame(spark, data)
    found = nearest(vectors.union(vectors), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(i + 1, 100 + i, 0.0) for i in range(10)]


def test_recall_while_a_twentieth_is_measured(spark):
    """One shard of vectors without any clusters, of which 5 % are measured."""
    data = made(8000, width=24, seed=9)
    queries = list(range(0, 8000, 100))
    hits = 0
    found = {}
    for r in nearest(frame(spark, data, 1), F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for query in queries:
        distance = ((data.astype(np.float64) - data[query]) ** 2).sum(axis=1)
        distance[query] = np.inf
        hits += len(found[query] & set(np.argsort(distance)[:10].tolist()))
    assert hits / (10 * len(queries)) > 0.9
