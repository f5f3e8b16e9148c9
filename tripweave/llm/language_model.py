"""Stupid-backoff scores of documents, from count tables over the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm.text import Block, blocks, count_words, large_binary, run_hashes
from tripweave.llm.workers import bound_batches, find_library
from tripweave.session import store

# Weight of a shorter n-gram.
BACKOFF = 0.4

# Words of the longest n-gram, unless the caller names another number.
ORDER = 2

# Bytes of the documents of a block; a longer document is a block of its own.
CHUNK_BYTES = 4 << 20

# Words of the corpus for each partition of a count table, and parts that meet in one.
PARTITION_WORDS = 4_000_000
PARTS = 4

# Numbers that are tried for each partition as labels of its parts.
LABELS_TRIED = 64

# While a count table is made: what a job shuffled goes from the disks when it ends, as its result is
# stored, rows that lie together by part are joined and grouped where they are, and n-grams are summed in
# one map, not first in a small one, which most of them would be looked up in for nothing.
COUNTING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
}

CHUNKS = "block long, n_words long, held binary"
ASKED = "part int, block long, grams array<long>, counts array<int>"
SCORES = "doc_id long, n_words long, n_backed_off long, log_score double"


def score_documents(
    docs: DataFrame, backoff: float = BACKOFF, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """How likely each document is by the n-grams of all others, of up to `order` words.

    `docs` has doc_id and text. Words are runs of characters other than ASCII
    white space, with A-Z in lower case. A word's score after the `order` - 1
    words before it, or as many as its document has there, is count(all of
    them) / count(those before); if they aren't there together, `backoff` *
    its score after one word less, down to count(word) / all words, which a
    document's first word takes at once. Counts are those of the whole corpus less the document's own, as
    every n-gram of it would be known otherwise; a word that only it has
    counts as one.

    Returns doc_id, n_words, n_backed_off (words scored by backoff, once each),
    log_score (sum of natural logarithms) and mean_log_score. Null texts and
    those without words have no words, a sum of 0 and a null mean. Rows that
    share a doc_id are documents of their own; null ids stay.

    Whole documents are stored in blocks of about `chunk_bytes`. For one
    length of n-grams after the other, a block's distinct n-grams and their
    counts in it go to the part that their hash names, of which each task has
    as many as any other. There they are exploded into rows, summed to that
    part's count table and joined with it;
    only n-grams that several blocks hold have an answer, since a block knows
    the rest. Each block's answers then meet its documents, whose scores are
    summed. The commonest n-gram takes a row a block.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = bound_batches(find_library(docs.sparkSession))
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chunks = store(given.mapInArrow(_chunks(chunk_bytes), CHUNKS), "blocks")
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // PARTITION_WORDS))
    labels, told = _labels(spark, partitions), None
    for size in range(1, order + 1):
        with _counting(spark):
            found = store(_told(chunks, size, partitions, labels), f"counts-{size}").withColumn("size", F.lit(size))
        told = found if told is None else told.unionByName(found)
    scored = (
        chunks.select("block", "held")
        .groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(_score(labels, backoff, order, words), SCORES)
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.withColumn("mean_log_score", mean)


@contextmanager
def _counting(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in COUNTING}
    try:
        for key, value in COUNTING.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _labels(spark: SparkSession, partitions: int) -> np.ndarray:
    """Numbers of the parts, by whose hashes a shuffle deals as many to each of `partitions`.

    Of parts numbered in turn many would fall into one partition and few into another.
    """
    tried = spark.range(partitions * LABELS_TRIED).select(F.col("id").cast("int").alias("label"))
    dealt = tried.groupBy(F.pmod(F.hash("label"), F.lit(partitions)).alias("at")).agg(F.collect_list("label").alias("labels"))
    found = dealt.select("at", F.slice(F.array_sort("labels"), 1, PARTS).alias("labels")).orderBy("at").collect()
    return np.array([label for row in found for label in row.labels], np.int32)


def _told(chunks: DataFrame, size: int, partitions: int, labels: np.ndarray | None = None) -> DataFrame:
    """For each block and part, which of its n-grams there other blocks hold too, and their counts over all.

    Both sides of the join read one exchange, that by parts.
    """
    labels = _labels(chunks.sparkSession, partitions) if labels is None else labels
    asked = chunks.select("block", "held").mapInArrow(_ask(size, labels), ASKED)
    parts = asked.repartition(partitions, "part")
    grams = parts.select("part", "block", "counts", F.posexplode("grams").alias("place", "gram")).select(
        "part", "block", "place", "gram", F.col("counts")[F.col("place")].alias("n")
    )
    counts = grams.groupBy("part", "gram").agg(F.sum("n").alias("total"), F.count("block").alias("holders"))
    known = counts.where("holders > 1").select("part", "gram", "total").hint("shuffle_hash")
    return (
        grams.join(known, ["part", "gram"])
        .where(F.col("total") > F.col("n"))
        .groupBy("part", "block")
        .agg(F.collect_list("place").alias("places"), F.collect_list("total").alias("totals"))
    )


def _chunks(size: int):
    """Rows of whole documents of about `size` bytes together, which are held compressed."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = large_binary(batch.column(1))
            ends = np.cumsum(_lengths(texts))
            row = 0
            while row < batch.num_rows:
                done = ends[row - 1] if row else 0
                stop = min(max(int(np.searchsorted(ends, done + size, side="right")), row + 1), batch.num_rows)
                own = texts.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([count_words(own)], pa.int64()),
                        pa.array([_packed(batch.column(0).slice(row, stop - row), own)], pa.binary()),
                    ],
                    names=["block", "n_words", "held"],
                )
                block += 1
                row = stop

    return chunks


def _packed(ids: pa.Array, texts: pa.Array) -> bytes:
    rows = pa.RecordBatch.from_arrays([ids, texts], names=["id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> tuple[pa.ChunkedArray, list[Block]]:
    """The ids of a row of documents, and their texts in blocks for hashing."""
    rows = pa.ipc.open_stream(held).read_all()
    return rows.column("id"), list(blocks(rows.column("text"), lower=True))


def _lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])


def _lists(values: pa.Array, edges) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def _ask(size: int, labels: np.ndarray):
    """A block's distinct n-grams of `size` words with their counts in it, by parts, which `labels` name."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held in zip(*(batch.column(name).to_pylist() for name in ("block", "held")), strict=True):
                _, own = _unpacked(held)
                grams = np.concatenate([gram_hashes(part, size) for part in own])
                grams, counts = np.unique(grams[grams != 0], return_counts=True)
                edges = _edges(grams, len(labels))
                full = np.flatnonzero(np.diff(edges))
                edges = np.append(edges[full], len(grams))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels[full], pa.int32()),
                        pa.array(np.full(len(full), block), pa.int64()),
                        _lists(pa.array(grams.view(np.int64)), edges),
                        _lists(pa.array(counts, pa.int32()), edges),
                    ],
                    names=["part", "block", "grams", "counts"],
                )

    return ask


def gram_hashes(block: Block, size: int) -> np.ndarray:
    """A hash of the n-gram of its document that ends at each word; zero for words with too few before them."""
    ending = np.zeros(len(block.words), np.uint64)
    ending[size - 1 :] = run_hashes(block.words, size)
    ending[_places(block) < size - 1] = 0
    return ending


def _places(block: Block) -> np.ndarray:
    """Each word's number within its document."""
    return np.arange(len(block.words)) - np.repeat(block.first[:-1], block.counts)


def _edges(grams: np.ndarray, n: int) -> np.ndarray:
    """Where each part's n-grams begin among sorted ones: parts are ascending ranges of hashes."""
    return np.searchsorted((grams >> np.uint64(32)).astype(np.int64) * n >> 32, np.arange(n + 1))


def _score(labels: np.ndarray, backoff: float, order: int, corpus_words: int):
    def score(key: tuple, given: pa.Table, told: pa.Table) -> pa.Table:
        ids, held = _unpacked(given.column("held")[0].as_py())
        counts = [_others(held, size, labels, told.filter(pc.field("size") == size)) for size in range(1, order + 1)]
        rows, at = [], 0
        for block in held:
            span = slice(at, at + len(block.words))
            rows.append(_document_scores(block, [c[span] for c in counts], corpus_words, backoff))
            at = span.stop
        n_words, backed_off, sums = (np.concatenate(part) for part in zip(*rows, strict=True))
        return pa.table(
            {
                "doc_id": ids.combine_chunks(),
                "n_words": pa.array(n_words, pa.int64()),
                "n_backed_off": pa.array(backed_off, pa.int64()),
                "log_score": pa.array(sums, pa.float64()),
            }
        )

    return score


def _others(held: list[Block], size: int, labels: np.ndarray, told: pa.Table) -> np.ndarray:
    """How often the n-gram that ends at each word of a block is in other documents; zero where none ends."""
    grams = np.concatenate([gram_hashes(block, size) for block in held])
    others = np.zeros(len(grams), np.int64)
    ends = np.flatnonzero(grams)
    if not len(ends):
        return others
    order, ordered = _sorted(grams[ends])
    ends = ends[order]
    fresh = ordered[1:] != ordered[:-1]
    first = _starts(fresh)
    totals = np.diff(first)
    edges = dict(zip(labels.tolist(), _edges(ordered[first[:-1]], len(labels)), strict=False))
    repeats = totals.copy()
    for part, places, over_all in zip(told.column("part"), told.column("places"), told.column("totals"), strict=True):
        totals[edges[part.as_py()] + places.values.to_numpy()] = over_all.values.to_numpy()
    words = np.concatenate([block.counts for block in held])
    documents = np.repeat(np.arange(len(words)), words)[ends]
    own = np.diff(_starts(fresh | (documents[1:] != documents[:-1])))
    others[ends] = np.repeat(totals, repeats) - np.repeat(own, own)
    return others


def _sorted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes by ascending hash, equal ones as they stand, and the hashes so sorted.

    The upper bits are sorted as values with the places below them, which is
    faster than to sort places by their hashes; where hashes that differ in the
    lower bits alone come out of order, places are sorted after all.
    """
    below = np.uint64((1 << len(grams).bit_length()) - 1)
    order = (np.sort((grams & ~below) | np.arange(len(grams), dtype=np.uint64)) & below).astype(np.int64)
    ordered = grams[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
    return order, ordered


def _starts(differs: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and where the last ends, by whether each value differs from the one before."""
    return np.concatenate([[0], np.flatnonzero(differs) + 1, [len(differs) + 1]])


def _document_scores(
    block: Block, others: list[np.ndarray], corpus_words: int, backoff: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, backed-off words and log scores of a block's documents, by counts without their own."""
    place, words = _places(block), block.counts
    score = np.log(np.maximum(others[0], 1) / np.repeat(np.maximum(corpus_words - words, 1), words))
    backed_off = np.zeros(len(score), bool)
    for shorter in range(1, len(others)):
        asked = place >= shorter
        known = asked & (others[shorter] > 0)
        before = np.roll(others[shorter - 1], 1)
        longer = np.log(np.maximum(others[shorter], 1) / np.maximum(before, 1))
        score = np.where(known, longer, np.where(asked, np.log(backoff) + score, score))
        backed_off = np.where(asked, ~known, backed_off)
    owner = np.repeat(np.arange(len(words)), words)
    sums = np.bincount(owner, score, len(words))
    return words, np.bincount(owner, backed_off, len(words)).astype(np.int64), sums
