"""Token ids of documents in files of Simple-8b blocks, in ascending order of id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripweave.llm import simple8b
from tripweave.llm.text import blocks
from tripweave.llm.tokens import END_ID, encoder, vocabulary

# Ids that a chunk of a file gathers before it is packed; a longer document makes a longer chunk.
CHUNK_IDS = 1 << 20

# A chunk: whole documents of one shard, and their ids as words, block offsets and escapes.
CHUNKS = (
    "shard int, chunk int, start long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
    "words binary, block_offsets binary, escapes binary"
)
DOCUMENTS = "shard int, doc_id long, shard_start long, n_tokens long, ids binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode `docs` (doc_id, text) and write their ids to files below `path`.

    Each document's ids are followed by `end_id`; a null text is empty. Files
    are Parquet, so that a task that runs again replaces its own file, on any
    store; a row is a chunk of Simple-8b words. A shard is one range of
    doc_id, and shards, chunks and documents ascend; null ids come first, and
    equal ids are ordered by text.
    """
    model = vocabulary(tokenizer)
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        chunks = _Chunks(TaskContext.get().partitionId())
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                for row, data in zip(block.rows, own.encode(block), strict=True):
                    yield from chunks.add(ids[row], data + end)
        yield from chunks.flush()

    ordered.mapInArrow(encoded, CHUNKS).write.option("compression", "uncompressed").parquet(path)


class _Chunks:
    """Gathers documents of a shard and packs them chunk by chunk."""

    def __init__(self, shard: int):
        self.shard, self.chunk, self.start = shard, 0, 0
        self.ids: list[int | None] = []
        self.data: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, data: bytes) -> Iterator[pa.RecordBatch]:
        self.ids.append(doc_id)
        self.data.append(data)
        self.held += len(data) // 4
        if self.held >= CHUNK_IDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        words, offsets, escapes = simple8b.encode(np.frombuffer(b"".join(self.data), "<u4"))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([self.shard], pa.int32()),
                pa.array([self.chunk], pa.int32()),
                pa.array([self.start], pa.int64()),
                pa.array([self.held], pa.int64()),
                pa.array([self.ids], pa.list_(pa.int64())),
                pa.array([[len(data) // 4 for data in self.data]], pa.list_(pa.int64())),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                pa.array([escapes.astype("<u4").tobytes()], pa.binary()),
            ],
            names=[field.split()[0] for field in CHUNKS.split(", ")],
        )
        self.chunk += 1
        self.start += self.held
        self.ids, self.data, self.held = [], [], 0


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    `start` counts the ids of all documents before it, over all shards.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)
    # One row per shard, and so per file: few, whatever the corpus holds.
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row)

    return (
        chunks.mapInArrow(decoded, DOCUMENTS)
        .join(F.broadcast(shards), "shard")
        .select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids")
    )


def _documents(row: dict) -> Iterator[pa.RecordBatch]:
    ids = simple8b.decode(
        np.frombuffer(row["words"], "<u8"),
        np.frombuffer(row["block_offsets"], "<u4"),
        np.frombuffer(row["escapes"], "<u4"),
        row["n_ids"],
    ).astype("<u4")
    counts = np.array(row["doc_tokens"], np.int64)
    ends = np.cumsum(counts)
    data = ids.tobytes()
    # A few documents at a time, so that a batch stays small.
    for i in range(0, len(counts), 256):
        part = slice(i, i + 256)
        starts = ends[part] - counts[part]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), row["shard"], np.int32)),
                pa.array(row["doc_ids"][part], pa.int64()),
                pa.array(starts + row["start"]),
                pa.array(counts[part]),
                pa.array([data[4 * a : 4 * b] for a, b in zip(starts, ends[part], strict=True)], pa.binary()),
            ],
            names=["shard", "doc_id", "shard_start", "n_tokens", "ids"],
        )
