"""Removal of repeated passages, by suffix trees of groups of suffixes that share a prefix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tripweave.llm.text import Block, blocks, mix, run_hashes
from tripweave.llm.workers import find_library
from tripweave.session import store

WINDOW = 20

# Words of a short prefix. Every window of 20 words holds 13 of them.
PREFIX = 8
INNER = WINDOW - PREFIX

# Suffixes of one tree, which a task holds at once. A prefix that more suffixes share is lengthened to a
# whole window, whose suffixes are one leaf and need no tree.
TREE_ROWS = 4096

# Length of the prefix of a row that no tree has to judge: its windows are known repeats.
KNOWN = 0

# A row without doc_id sorts as this one.
NO_ID = -(1 << 63)

ADDED = ("n_words", "n_removed", "kept")
# Rows of one doc are told apart by text_hash throughout.
ANCHORS = "prefix long, doc long, text_hash long, place int"
SUFFIXES = "prefix long, length int, doc long, text_hash long, place int, offsets int, around binary"
REPEATS = "doc long, text_hash long, place int, offsets int"


class Anchors:
    """Of each window of a block's documents, the least of its prefixes' hashes.

    Equal windows choose the same prefix at the same offset, so the
    chosen suffixes alone show every repeated window. `place` is a
    chosen prefix's first word, `low` to `high` the first words of the windows
    that chose it, `doc` its document; all count within the block.
    """

    def __init__(self, block: Block):
        counts = block.counts
        hashes = run_hashes(block.words, PREFIX)
        self.hashes = hashes
        starts = np.arange(max(len(block.words) - WINDOW + 1, 0))
        ends = np.repeat(block.first[1:], counts)[: len(starts)]
        starts = starts[starts + WINDOW <= ends]
        if not len(starts):
            self.place = self.low = self.high = self.doc = np.zeros(0, np.int64)
            return
        view = np.lib.stride_tricks.sliding_window_view(hashes, INNER + 1)
        chosen = starts + view[starts].argmin(axis=1)
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(fresh)
        self.place = chosen[at]
        self.low = starts[at]
        self.high = starts[np.append(at[1:], len(starts)) - 1]
        self.doc = np.searchsorted(block.first, self.place, side="right") - 1

    @property
    def prefix(self) -> np.ndarray:
        return self.hashes[self.place].view(np.int64)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Cut from each text the words of windows that occur earlier in the corpus.

    `docs` has doc_id, text and any other columns, which are kept. Words are
    runs of characters other than ASCII white space, unchanged. A window is 20
    consecutive words of one document; all words of a window are removed if
    the same words also start earlier: in a document of smaller doc_id, or
    earlier in the same one. Windows are judged on the texts as given.

    Adds n_words, n_removed and kept, the remaining words joined by one space,
    in place of any columns of these names. A null text has no words; a null
    doc_id counts as the smallest, -2^63. Rows that share a doc_id stand at the
    same place in the order: a window at the same position of two of them
    repeats neither. Windows are compared by 64-bit hashes of prefixes and
    32-bit hashes of the words around them.

    Suffixes are cut down to those that begin with the least prefix of some
    window (one in seven), and prefixes that occur once go no further. The
    others' suffixes are split into groups by prefixes of two lengths: 8 words
    or, where more than `TREE_ROWS` suffixes share those, the 20 words of a
    window. Each group of 8 is a suffix tree, and a second one of the words
    before the prefix, read backwards; see `SuffixTree`. A group of 20 is a
    leaf, however many suffixes it has: the earliest comes first, the others
    pass by, and each block of text sends its earliest only.
    """
    find_library(docs.sparkSession)
    kept = [field.name for field in docs.schema.fields if field.name not in ("text", *ADDED)]
    given = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
        F.struct(*[F.col(f"`{name}`") for name in kept]).alias("rest"),
    )
    anchors = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(_anchor_rows, ANCHORS)
    # Stored, so that the join reads two plain shuffles, whose hot prefixes Spark can split.
    often = store(anchors.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1"), "prefixes")
    places = (
        anchors.join(often, "prefix")
        .groupBy("doc", "text_hash")
        .agg(F.collect_set(F.struct("place", (F.col("n") > TREE_ROWS).alias("long"))).alias("places"))
    )
    # The same columns as in the join below, so that both read one exchange of the texts.
    suffixes = given.join(places, ["doc", "text_hash"]).select("doc", "text_hash", "text", "places", "rest").mapInArrow(_suffix_rows, SUFFIXES)
    repeats = (
        suffixes.repartition("prefix")
        .sortWithinPartitions("prefix", "length", "doc", "place")
        .mapInArrow(_subtrees, REPEATS)
        .groupBy("doc", "text_hash")
        .agg(F.collect_set(F.struct("place", "offsets")).alias("repeats"))
    )
    joined = given.join(repeats, ["doc", "text_hash"], "left").select("doc", "text_hash", "text", "repeats", "rest")
    result = T.StructType([given.schema["text"]])
    result.add("n_words", "long").add("n_removed", "long").add("kept", "string").add(given.schema["rest"])
    shown = [
        F.col("text") if name == "text" else F.col("rest").getField(name).alias(name) for name in docs.columns if name not in ADDED
    ]
    return joined.mapInArrow(_cut_rows, result).select(*shown, *ADDED)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for block in blocks(batch.column(2)):
            found = Anchors(block)
            if len(found.place):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.prefix),
                        pa.array(docs[block.rows.start + found.doc]),
                        pa.array(texts[block.rows.start + found.doc]),
                        pa.array((found.place - block.first[found.doc]).astype(np.int32)),
                    ],
                    names=["prefix", "doc", "text_hash", "place"],
                )


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A suffix of each repeated prefix, with the words that its windows reach to either side.

    `offsets` has a bit for each window that chose the prefix: how many words
    it begins before the prefix. A suffix of a long prefix is one window; of
    equal ones in a block the earliest goes on, and the others are known
    repeats.
    """
    for batch in batches:
        docs, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        lists = batch.column(3)
        for block in blocks(batch.column(2)):
            found = Anchors(block)
            if not len(found.place):
                continue
            length = np.full(len(found.place), -1, np.int8)
            inner = found.place - block.first[found.doc]
            own = np.searchsorted(found.doc, np.arange(len(block.rows) + 1))
            for i, row in enumerate(block.rows):
                part = slice(own[i], own[i + 1])
                listed = lists[row].values
                places = listed.field("place").to_numpy()
                order = np.argsort(places, kind="stable")
                at = np.searchsorted(places[order], inner[part])
                at = np.minimum(at, len(places) - 1)
                hit = places[order][at] == inner[part]
                is_long = listed.field("long").to_numpy(zero_copy_only=False)[order][at]
                length[part] = np.where(hit, is_long, -1)
            texts = hashes[block.rows.start :][: len(block.rows)]
            doc_of = docs[block.rows.start :][: len(block.rows)]
            short = np.flatnonzero(length == 0)
            if len(short):
                place, low, high = found.place[short], found.low[short], found.high[short]
                bits = (2 << (place - low)) - (1 << (place - high))
                yield _suffix_batch(
                    found.prefix[short],
                    PREFIX,
                    doc_of[found.doc[short]],
                    texts[found.doc[short]],
                    inner[short],
                    bits,
                    _around(block, place),
                )
            long = np.flatnonzero(length == 1)
            if len(long):
                sizes = found.high[long] - found.low[long] + 1
                at = np.repeat(long, sizes)
                starts = np.repeat(found.low[long], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                windows = run_hashes(block.words, WINDOW)[starts]
                owner = found.doc[at]
                inside = starts - block.first[owner]
                order = np.lexsort((inside, doc_of[owner], windows))
                known = np.zeros(len(order), bool)
                same = windows[order][1:] == windows[order][:-1]
                known[1:] = same
                # Only what starts later than the earliest is a repeat.
                first = np.maximum.accumulate(np.where(known, 0, np.arange(len(order))))
                later = (doc_of[owner][order] != doc_of[owner][order][first]) | (inside[order] != inside[order][first])
                gone = known & later
                first = order[~gone]
                yield _suffix_batch(
                    windows[first].view(np.int64),
                    WINDOW,
                    doc_of[owner[first]],
                    texts[owner[first]],
                    inside[first],
                    np.ones(len(first), np.int64),
                    None,
                )
                if gone.any():
                    # One row for all windows of a prefix; it goes anywhere.
                    repeats = np.zeros(len(found.place), np.int64)
                    np.bitwise_or.at(repeats, at[order[gone]], 1 << (found.place[at] - starts)[order[gone]])
                    hit = np.flatnonzero(repeats)
                    spread = mix(texts[found.doc[hit]].view(np.uint64) + hit.astype(np.uint64))
                    yield _suffix_batch(
                        spread.view(np.int64),
                        KNOWN,
                        doc_of[found.doc[hit]],
                        texts[found.doc[hit]],
                        inner[hit],
                        repeats[hit],
                        None,
                    )


def _around(block: Block, place: np.ndarray) -> np.ndarray:
    """32-bit hashes of the 12 words before and after each prefix; 0 beyond the block."""
    padded = np.zeros(len(block.words) + 2 * INNER, np.uint32)
    padded[INNER : INNER + len(block.words)] = block.words >> np.uint64(32)
    before = np.lib.stride_tricks.sliding_window_view(padded, INNER)
    return np.concatenate([before[place], before[place + INNER + PREFIX]], axis=1)


def _suffix_batch(prefix, length, doc, text_hash, place, offsets, around) -> pa.RecordBatch:
    n = len(prefix)
    if around is None:
        data = pa.array([b""] * n, pa.binary())
    else:
        width = 4 * around.shape[1]
        places = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32).tobytes())
        data = pa.Array.from_buffers(pa.binary(), n, [None, places, pa.py_buffer(np.ascontiguousarray(around))])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prefix, pa.int64()),
            pa.array(np.full(n, length, np.int32)),
            pa.array(doc, pa.int64()),
            pa.array(text_hash, pa.int64()),
            pa.array(place.astype(np.int32)),
            pa.array(offsets.astype(np.int32)),
            data,
        ],
        names=[field.split()[0] for field in SUFFIXES.split(", ")],
    )


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Find the repeats of each group of a sorted partition.

    Only a last group of short prefixes, of `TREE_ROWS` at most, waits for more
    rows; of a last window, its earliest place is kept.
    """
    waiting: pa.Table | None = None
    earliest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows]).combine_chunks()
            waiting = None
        if not len(rows):
            continue
        prefix, length = rows.column("prefix").to_numpy(), rows.column("length").to_numpy()
        if length[-1] == PREFIX:
            cut = int(np.flatnonzero((prefix == prefix[-1]) & (length == PREFIX))[0])
            waiting = rows.slice(cut)
            rows, prefix, length = rows.slice(0, cut), prefix[:cut], length[:cut]
        doc, place = rows.column("doc").to_numpy(), rows.column("place").to_numpy().astype(np.int64)
        repeated = np.where(length == KNOWN, rows.column("offsets").to_numpy().astype(np.int64), 0)
        windows = np.flatnonzero(length == WINDOW)
        if len(windows):
            later, earliest = _later(prefix[windows], doc[windows], place[windows], earliest)
            repeated[windows[later]] = 1
        yield _repeat_rows(rows, repeated | _tree_repeats(rows, np.flatnonzero(length == PREFIX)))
    if waiting is not None:
        yield _repeat_rows(waiting, _tree_repeats(waiting, np.arange(len(waiting))))


def _later(prefix: np.ndarray, doc: np.ndarray, place: np.ndarray, before: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which of the sorted windows start later than the first of their prefix, and the first of the last prefix.

    `before` is that of the windows before these.
    """
    if before is not None:
        prefix, doc, place = (np.concatenate([[a], b]) for a, b in zip(before, (prefix, doc, place), strict=True))
    fresh = np.ones(len(prefix), bool)
    fresh[1:] = prefix[1:] != prefix[:-1]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(prefix)), 0))
    later = (doc != doc[first]) | (place != place[first])
    last = first[-1]
    return later[1:] if before is not None else later, (prefix[last], doc[last], place[last])


class SuffixTree:
    """Suffix trees of all groups of a batch: leaves in order, and how deep neighbours part.

    `words` has a row of words for each suffix, those after its prefix. An inner
    node of depth d is a longest run of leaves in which each shares d words or
    more with the next; words of the prefix are not counted.
    """

    def __init__(self, prefix: np.ndarray, words: np.ndarray):
        n, width = words.shape
        keys = np.empty((n, width + 2), np.uint32)
        keys[:, :2] = prefix.view(np.uint32).reshape(-1, 2)
        keys[:, 2:] = words
        # Any order of words will do, so that of their bytes does.
        self.leaves = np.argsort(keys.view(f"S{4 * (width + 2)}").reshape(-1), kind="stable")
        same = keys[self.leaves][1:] == keys[self.leaves][:-1]
        inside = same[:, :2].all(axis=1)
        shared = np.minimum.accumulate(same[:, 2:], axis=1).sum(axis=1)
        # Words shared with the leaf before; -1 where another tree begins.
        self.shared = np.concatenate([[-1], np.where(inside, shared, -1)]) if n else np.zeros(0, np.int64)

    def parents(self) -> np.ndarray:
        """For each suffix, the depth of the node that its leaf hangs from; -1 in a tree of one leaf."""
        depth = np.empty(len(self.leaves), np.int64)
        depth[self.leaves] = np.maximum(self.shared, np.append(self.shared[1:], -1))
        return depth

    def nodes(self, depth: int) -> np.ndarray:
        """For each suffix, the topmost node or leaf above it that is `depth` words deep or more."""
        node = np.empty(len(self.leaves), np.int64)
        node[self.leaves] = np.cumsum(self.shared < depth)
        return node


def _tree_repeats(rows: pa.Table, own: np.ndarray) -> np.ndarray:
    """Of each row, the windows that start later than an equal one, as bits of offsets.

    A window that begins o words before a prefix ends 12 - o words behind it.
    Equal ones lie below one node of that depth in the tree of the words behind
    the prefix and below one of depth o in the tree of the words before it. A
    leaf that hangs from nodes of fewer than 12 words together has no such window.
    """
    repeated = np.zeros(len(rows), np.int64)
    if len(own) < 2:
        return repeated
    part = rows.take(pa.array(own)).combine_chunks()
    prefix = part.column("prefix").to_numpy()
    around = part.column("around").chunk(0)
    offset = np.frombuffer(around.buffers()[1], np.int32)[around.offset]
    words = np.frombuffer(around.buffers()[2], np.uint32, len(own) * 2 * INNER, int(offset)).reshape(-1, 2 * INNER)
    behind, before = SuffixTree(prefix, words[:, INNER:]), SuffixTree(prefix, words[:, INNER - 1 :: -1])
    deep = np.flatnonzero(behind.parents() + before.parents() >= INNER)
    doc, place = part.column("doc").to_numpy()[deep], part.column("place").to_numpy()[deep].astype(np.int64)
    offsets = part.column("offsets").to_numpy()[deep]
    for offset in range(INNER + 1):
        on = np.flatnonzero(offsets >> offset & 1)
        if len(on) < 2:
            continue
        passage = (behind.nodes(INNER - offset) * (len(own) + 1) + before.nodes(offset))[deep[on]]
        order = on[np.lexsort((place[on], doc[on], passage))]
        later, _ = _later(np.sort(passage), doc[order], place[order], None)
        repeated[own[deep[order[later]]]] |= 1 << offset
    return repeated


def _repeat_rows(rows: pa.Table, repeated: np.ndarray) -> pa.RecordBatch:
    hit = np.flatnonzero(repeated)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows.column("doc").to_numpy()[hit]),
            pa.array(rows.column("text_hash").to_numpy()[hit]),
            pa.array(rows.column("place").to_numpy()[hit]),
            pa.array(repeated[hit].astype(np.int32)),
        ],
        names=["doc", "text_hash", "place", "offsets"],
    )


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(2)):
            part = batch.slice(block.rows.start, len(block.rows))
            counts, removed, texts = block.counts, [], []
            data = block.data.tobytes()
            for i in range(len(block.rows)):
                span = slice(block.first[i], block.first[i + 1])
                gone = np.zeros(counts[i] + 1, np.int32)
                listed = part.column(3)[i].values
                if listed is not None and len(listed):
                    place = listed.field("place").to_numpy().astype(np.int64)
                    offsets = listed.field("offsets").to_numpy()
                    for offset in range(INNER + 1):
                        start = place[offsets >> offset & 1 == 1] - offset
                        np.add.at(gone, start, 1)
                        np.add.at(gone, start + WINDOW, -1)
                stays = np.cumsum(gone)[:-1] == 0
                removed.append(int(counts[i] - np.count_nonzero(stays)))
                places = zip(block.begin[span][stays].tolist(), block.end[span][stays].tolist(), strict=True)
                texts.append(b" ".join([data[a:b] for a, b in places]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(2),
                    pa.array(counts.astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array(texts, pa.string()),
                    part.column(4),
                ],
                names=["text", "n_words", "n_removed", "kept", "rest"],
            )
