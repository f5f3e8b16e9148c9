"""Fingerprints of texts: shared random walks map edit distance to Hamming distance, whose bits are sampled."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripweave.llm.columns import with_columns
from tripweave.llm.text import large_binary, mix
from tripweave.llm.workers import find_library
from tripweave.session import store

# Independent walks, and bits sampled from each.
WALKS = 2
SAMPLES = 256
BITS = WALKS * SAMPLES

# Characters are told apart by class; a walk's coin flips repeat after PERIOD steps.
CLASSES = 256
PERIOD = 4096

# Bands of a fingerprint, and the bits that each takes from it. Two texts of
# likeness 0.8 share no band with a chance of 2e-4, unrelated ones some band with 2e-4.
BANDS = 64
BAND_BITS = 20

# Likeness from which two texts count as near.
NEAR = 0.8

# Characters whose walks a task takes side by side; a longer text has a lot of its own.
LOT = 1 << 23

PRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, edited_bands int, next_bands int"
)
_FIELDS = [field.split()[0] for field in PRINTED.split(", ")]


@cache
def _gaps() -> np.ndarray:
    """Steps that a walk stays on a character of a class, by walk and by class and time.

    At each step a coin, the same for all texts, says by walk, time and class
    whether the walk moves on to the next character.
    """
    moves = np.random.RandomState(12).randint(0, 2, (WALKS, CLASSES, PERIOD)).astype(bool)
    time = np.arange(2 * PERIOD)
    twice = np.where(np.concatenate([moves, moves], axis=2), time, 2 * PERIOD)
    following = np.minimum.accumulate(twice[:, :, ::-1], axis=2)[:, :, ::-1][:, :, :PERIOD]
    return np.minimum(following - time[:PERIOD] + 1, 255).astype(np.uint8).reshape(WALKS, -1)


@cache
def _records() -> list[np.ndarray]:
    """Times that each sample looks at: of an embedding of length n, the last below n.

    They are the records of a random priority over all times, so each time is
    looked at with equal chance, and embeddings of nearly equal length are
    nearly always looked at in the same place.
    """
    random, found = np.random.RandomState(13), []
    for _ in range(BITS):
        times = [0]
        while times[-1] < 1 << 44:
            times.append(max(times[-1] + 1, int(np.ceil((times[-1] + 1) / random.uniform(1e-9, 1))) - 1))
        found.append(np.array(times))
    return found


@cache
def _signs() -> np.ndarray:
    """The bit that a sample gives each class of characters, and, last, the end of a text."""
    return np.random.RandomState(14).randint(0, 2, (BITS, CLASSES + 1)).astype(np.uint8)


@cache
def _band_places() -> np.ndarray:
    random = np.random.RandomState(15)
    return np.stack([random.choice(BITS, BAND_BITS, replace=False) for _ in range(BANDS)])


def letters_of(text: str) -> np.ndarray:
    """Classes of a text's characters; ASCII has a class each."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(codes < 128, codes, 128 + mix(codes.astype(np.uint64)) % 128).astype(np.uint8)


def walk_gaps(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How long each walk stays on each character of some texts, and each walk's length on each text.

    All texts are walked side by side, one character of each at a time.
    """
    order = np.argsort(-sizes, kind="stable")
    longest = -sizes[order]
    at = starts[order].copy()
    gaps = np.zeros((WALKS, len(letters)), np.uint8)
    times = np.zeros((WALKS, len(order)), np.int64)
    tables, done = list(_gaps()), 0
    for size in np.unique(sizes).tolist():
        active = int(np.searchsorted(longest, -size, side="right"))
        here, clocks = at[:active], [clock[:active] for clock in times]
        for _ in range(size - done):
            row = letters[here].astype(np.int64) * PERIOD
            for table, clock, out in zip(tables, clocks, gaps, strict=True):
                stay = table[row + (clock & (PERIOD - 1))]
                out[here] = stay
                clock += stay
            here += 1
        done = size
    lengths = np.empty_like(times)
    lengths[:, order] = times
    return gaps, lengths


def fingerprints(texts: list[str]) -> np.ndarray:
    """The fingerprint of each text, a row of bytes: the sampled bits of its embeddings."""
    parts = [letters_of(text) for text in texts]
    sizes = np.array([len(part) for part in parts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if parts else sizes
    letters = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    gaps, lengths = walk_gaps(letters, starts, sizes)
    signs, samples = _signs(), np.arange(SAMPLES)
    bits = np.tile(signs[:, CLASSES], (len(texts), 1))
    for walk in range(WALKS):
        own = slice(walk * SAMPLES, (walk + 1) * SAMPLES)
        looked = np.stack([times[np.searchsorted(times, lengths[walk]) - 1] for times in _records()[own]], axis=1)
        for i in np.flatnonzero(sizes):
            span = slice(starts[i], starts[i] + sizes[i])
            leaves = np.cumsum(gaps[walk, span], dtype=np.int64)
            seen = letters[span][np.searchsorted(leaves, looked[i], side="right")]
            bits[i, own] = signs[own][samples, seen]
    return np.packbits(bits, axis=1)


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints row by row: the share of equal bits beyond the half that chance makes equal."""
    unequal = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(0.0, 1.0 - 2.0 * unequal / BITS)


def bands_of(prints: np.ndarray) -> np.ndarray:
    """Each fingerprint's band keys: the bits that a band samples, with the band's number."""
    bits = np.unpackbits(prints, axis=1)[:, _band_places()].astype(np.int64)
    values = (bits << np.arange(BAND_BITS)).sum(axis=2)
    return values + (np.arange(BANDS) << BAND_BITS)


def _fixed(prints: np.ndarray) -> pa.Array:
    width = BITS // 8
    places = pa.py_buffer((np.arange(len(prints) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(prints), [None, places, pa.py_buffer(np.ascontiguousarray(prints))])


def _lots(column: pa.Array, size: int = LOT) -> Iterator[tuple[int, list[str]]]:
    """The texts of a column, a null being empty, in lots of about `size` bytes: (first row, texts)."""
    column = large_binary(column)
    ends = np.cumsum(pc.binary_length(column).to_numpy()) if len(column) else np.zeros(0, np.int64)
    row = 0
    while row < len(column):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield row, [text.decode("utf-8", "replace") for text in column.slice(row, stop - row).to_pylist()]
        row = stop


def add_fingerprints(docs: DataFrame) -> DataFrame:
    """Add `fingerprint` (64 bytes) and `bands` (64 longs) to texts, in place of columns of these names.

    Equal texts have equal fingerprints. A null text is an empty one, whose
    bits are those of a text's end. Other columns, repeated rows and null ids
    pass as they are.
    """
    find_library(docs.sparkSession)

    def step(texts: pa.Array) -> list[pa.Array]:
        prints = [fingerprints(lot) for _, lot in _lots(texts)] or [np.zeros((0, BITS // 8), np.uint8)]
        prints = np.concatenate(prints)
        keys = bands_of(prints)
        places = pa.array((np.arange(len(keys) + 1) * BANDS).astype(np.int32))
        return [_fixed(prints), pa.ListArray.from_arrays(places, pa.array(keys.reshape(-1)))]

    return with_columns(docs, {"fingerprint": "binary", "bands": T.ArrayType(T.LongType())}, step)


def likeness(a: str, b: str) -> Column:
    """Likeness of two fingerprint columns, 0 to 1, by counts of their equal bits."""
    words = [
        F.bit_count(F.conv(F.hex(F.substring(a, at, 8)), 16, -10).cast("long").bitwiseXOR(F.conv(F.hex(F.substring(b, at, 8)), 16, -10).cast("long")))
        for at in range(1, BITS // 8 + 1, 8)
    ]
    return F.greatest(F.lit(0.0), 1 - 2 * sum(words) / F.lit(float(BITS)))


def find_near_texts(docs: DataFrame, queries: DataFrame, least: float = NEAR) -> DataFrame:
    """Documents whose text is near that of a query: query_id, doc_id, n_docs, likeness.

    `docs` and `queries` have doc_id and text. Documents of one fingerprint,
    such as exact copies, make one class: doc_id is the smallest of them and
    n_docs says how many rows they are; those without doc_id count only where
    the class has no other. Fingerprints that share a band are candidates,
    the whole fingerprints decide. A query is found by itself, if it is a document.
    Queries of one fingerprint are looked up once. A null text is an empty
    one, which is near empty ones only; rows without a match are left out.
    """
    found = store(add_fingerprints(docs.select("doc_id", "text")).drop("text"), "fingerprints")
    classes = found.groupBy("fingerprint").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs"), F.any_value("bands").alias("bands")
    )
    asked = store(add_fingerprints(queries.select(F.col("doc_id").alias("query_id"), "text")).drop("text"), "asked")
    looked = asked.groupBy(F.col("fingerprint").alias("asked")).agg(F.any_value("bands").alias("bands"))
    classes = store(classes, "classes")
    shared = classes.select("fingerprint", F.explode("bands").alias("band")).join(looked.select("asked", F.explode("bands").alias("band")), "band")
    pairs = shared.select("fingerprint", "asked").distinct().withColumn("likeness", likeness("fingerprint", "asked")).where(F.col("likeness") >= least)
    near = pairs.join(classes.drop("bands"), "fingerprint").select("asked", "doc_id", "n_docs", "likeness")
    named = asked.select("query_id", F.col("fingerprint").alias("asked"))
    return named.join(near, "asked").select("query_id", "doc_id", "n_docs", "likeness")


def edited(text: str, following: str) -> str:
    """A text whose last third, rounded down, is replaced by as much of another's beginning, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how alike they are.

    `docs` has doc_id and text. Documents stand in descending order of doc_id,
    nulls last; rows of one id by their texts' hash. The edited text has the
    last third of its characters replaced by the beginning of the next
    document's text, that of the last by the first one's. A null text is empty.

    Returns a row per row of `docs`: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next (likeness of the
    fingerprint to the edited text's and to the next document's) and
    edited_bands and next_bands, how many bands they share.

    Texts move once, by range. A task compares neighbours as they pass by; the
    last row of each is met with the first row of the next afterwards. Of
    these, only the numbers of the partitions come to the driver.
    """
    spark = find_library(docs.sparkSession)
    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("_at")]
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_at"),
    )
    placed = given.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = store(placed.mapInArrow(_walk_on, f"{PRINTED}, part int, head string, tail string"), "compared")
    heads = walked.where("head is not null").select(F.col("part").alias("next"), F.col("head").alias("following"), F.col("fingerprint").alias("next_print"))
    parts = sorted(row.next for row in heads.select("next").collect())
    closed = walked.where("tail is null").select(*_FIELDS)
    if not parts:
        return closed
    turns = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, next int")
    last = walked.where("tail is not null").join(turns, "part").join(heads, "next")
    return closed.unionByName(last.select("doc_id", "tail", "fingerprint", "following", "next_print").mapInArrow(_closed, PRINTED))


def _rows(ids: list, texts: list[str], prints: np.ndarray, changed: list[str], changed_prints: np.ndarray, nexts: np.ndarray) -> list[pa.Array]:
    """Columns of PRINTED for rows whose next document is known."""
    bands = bands_of(prints)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(text) for text in texts], pa.int64()),
        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed], pa.string()),
        _fixed(prints),
        _fixed(changed_prints),
        pa.array(likenesses(prints, changed_prints)),
        pa.array(likenesses(prints, nexts)),
        pa.array((bands == bands_of(changed_prints)).sum(axis=1).astype(np.int32)),
        pa.array((bands == bands_of(nexts)).sum(axis=1).astype(np.int32)),
    ]


def _walk_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with the next.

    The last stays open, with its text as `tail`; the first has its text as `head`, too.
    """
    part, is_first = TaskContext.get().partitionId(), True
    names = [*_FIELDS, "part", "head", "tail"]
    ids, texts, prints = [], [], np.zeros((0, BITS // 8), np.uint8)
    for batch in batches:
        for row, lot in _lots(batch.column(1)):
            ids, texts = ids + batch.column(0).slice(row, len(lot)).to_pylist(), texts + lot
            changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
            made = fingerprints(lot + changed)
            prints = np.concatenate([prints, made[: len(lot)]])
            n = len(changed)
            if n:
                columns = _rows(ids[:n], texts[:n], prints[:n], changed, made[len(lot) :], prints[1:])
                heads = [texts[0] if is_first else None, *[None] * (n - 1)]
                is_first = False
                columns += [pa.array([part] * n, pa.int32()), pa.array(heads, pa.string()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            ids, texts, prints = ids[n:], texts[n:], prints[n:]
    if texts:
        known = {
            "doc_id": pa.array(ids, pa.int64()),
            "fingerprint": _fixed(prints),
            "part": pa.array([part], pa.int32()),
            "head": pa.array(texts if is_first else [None], pa.string()),
            "tail": pa.array(texts, pa.string()),
        }
        kinds = dict(field.split() for field in PRINTED.split(", "))
        yield pa.RecordBatch.from_arrays([known[n] if n in known else pa.nulls(1, _ARROW[kinds[n]]) for n in names], names=names)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the last rows of partitions with the first rows of the next ones."""
    for batch in batches:
        ids, texts, own, nexts, next_prints = (column.to_pylist() for column in batch.columns)
        if not ids:
            continue
        changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
        prints, next_prints = (np.frombuffer(b"".join(x), np.uint8).reshape(len(ids), -1) for x in (own, next_prints))
        yield pa.RecordBatch.from_arrays(_rows(ids, texts, prints, changed, fingerprints(changed), next_prints), names=_FIELDS)
