"""Periodic runs of words, found by branching squares in an enhanced suffix array."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tripweave.llm.columns import with_columns
from tripweave.llm.text import Block, blocks, mix, run_hashes
from tripweave.llm.workers import find_library

# A run has at least this many words, and at least two periods.
LEAST_RUN = 12

# Suffixes that are checked against their interval at a time.
CHECKED = 1 << 21

RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
ADDED = {"n_words": "long", "runs": T.ArrayType(RUN), "collapsed": "string"}
_SEPARATOR = np.uint64(0xD1B54A32D192ED03)


def find_runs(docs: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """Add n_words, runs and collapsed to documents, in place of any columns of these names.

    A run is a stretch of consecutive words with smallest period p, of `least`
    and 2 p words or more, that no neighbouring word extends keeping p. `runs`
    has every run of a text, by start, then period; `collapsed` the text's
    words joined by one space, but for those that some run holds after its
    first p. Words are runs of characters other than ASCII white space, compared
    by 64-bit hashes. A null or empty text has no words, no runs and an empty
    `collapsed`; other columns, repeated rows and null ids pass as they are.
    Texts are looked at one by one, so nothing is moved.
    """
    find_library(docs.sparkSession)

    def step(texts: pa.Array) -> list[pa.Array]:
        n_words, n_runs, found, left = [], [], [], []
        for block in blocks(texts):
            doc, start, end, period = block_runs(block, least)
            n_words.append(block.counts)
            n_runs.append(np.bincount(doc, minlength=len(block.rows)))
            found.append(np.stack([start, end - start, period]))
            left += collapsed_texts(block, doc, start, end, period)
        places = np.concatenate([[0], np.cumsum(np.concatenate(n_runs))]) if n_runs else np.zeros(1, np.int64)
        columns = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        structs = pa.StructArray.from_arrays([pa.array(column.astype(np.int64)) for column in columns], names=RUN.names)
        return [
            pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
            pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), structs),
            pa.array(left, pa.binary()).view(pa.string()),
        ]

    return with_columns(docs, ADDED, step)


def block_runs(block: Block, least: int = LEAST_RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, period) of all runs of a block, by document, start and period."""
    chosen = np.flatnonzero(_may_repeat(block, -(-least // 2)))
    counts = block.counts[chosen]
    # The words of the chosen documents, each document with a separator behind it.
    places = np.concatenate([[0], np.cumsum(counts + 1)])
    owner = np.repeat(np.arange(len(chosen)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys = np.empty(places[-1], np.uint64)
    keys[places[1:] - 1] = mix(np.arange(len(chosen)).astype(np.uint64) + _SEPARATOR)
    words = block.words[np.repeat(block.first[chosen], counts) + inner]
    # Equal words of two documents are different letters, so no comparison crosses documents.
    keys[places[owner] + inner] = mix(words ^ mix(owner.astype(np.uint64)))
    start, end, period = runs_of(keys, least)
    doc = np.searchsorted(places, start, side="right") - 1
    order = np.lexsort((period, start))
    doc, start, end, period = (column[order] for column in (doc, start, end, period))
    return chosen[doc], start - places[doc], end - places[doc], period


def _may_repeat(block: Block, size: int) -> np.ndarray:
    """Documents in which some `size` words occur twice; others have no run.

    A run of period p repeats all its words but the first p at a distance of
    p, so `size` words, half the least run, occur twice in it.
    """
    hashes, first = block.shingles(size)
    owner = np.repeat(np.arange(len(block.rows)), np.diff(first))
    keys = mix(hashes ^ mix(owner.astype(np.uint64)))
    order = np.argsort(keys)
    again = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(block.rows), bool)
    found[owner[order[1:][again]]] = True
    return found


class SuffixArray:
    """Sorted suffixes of a sequence: `order`, its inverse `place`, and common prefixes.

    Every letter run must be told from any other before the sequence ends, as
    by separators that occur once. `ranks[k]` ranks suffixes by their first
    2**k letters. `common[t]` is the length of the common prefix of the
    suffixes at t - 1 and t; it is -1 before the first and behind the last.
    """

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        order = np.argsort(keys)
        fresh = np.ones(n, bool)
        fresh[1:] = keys[order][1:] != keys[order][:-1]
        # A suffix's rank is the place of the first that is equal so far.
        place = np.empty(n, np.int64)
        place[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.ranks = [place]
        open_ = order[~(fresh & np.append(fresh[1:], True))]
        size = 1
        while len(open_):
            now = self.ranks[-1]
            keyed = now[open_] * (n + 1) + now[open_ + size]
            by = np.argsort(keyed, kind="stable")
            open_, keyed = open_[by], keyed[by]
            group = now[open_]
            at = np.arange(len(open_))
            fresh = np.ones(len(open_), bool)
            fresh[1:] = keyed[1:] != keyed[:-1]
            opens = np.ones(len(open_), bool)
            opens[1:] = group[1:] != group[:-1]
            first = np.maximum.accumulate(np.where(fresh, at, 0))
            place = now.copy()
            place[open_] = group + first - np.maximum.accumulate(np.where(opens, at, 0))
            self.ranks.append(place)
            open_ = open_[~(fresh & np.append(fresh[1:], True))]
            size *= 2
        self.place = place
        self.order = np.empty(n, np.int64)
        self.order[place] = np.arange(n)
        self.common = np.full(n + 1, -1, np.int64)
        if n > 1:
            self.common[1:n] = self.extension(self.order[:-1], self.order[1:])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of different suffixes, pair by pair."""
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            equal = self.ranks[k][a] == self.ranks[k][b]
            step = equal.astype(np.int64) << k
            a += step
            b += step
            total += step
        return total

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters before places a and b are equal, pair by pair; a < b."""
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            size = 1 << k
            left = a >= size
            equal = left & (self.ranks[k][np.where(left, a - size, 0)] == self.ranks[k][np.where(left, b - size, 1)])
            step = equal.astype(np.int64) << k
            a -= step
            b -= step
            total += step
        return total

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """For each t, the last place before it whose common prefix is no longer, the next whose is shorter."""
        n = len(self.common)
        before, after = np.arange(n) - 1, np.arange(n) + 1
        for bound, longer in ((before, np.greater), (after, np.greater_equal)):
            # All between a place and its bound is longer, so jumping to a bound's own bound is safe.
            active = np.arange(1, n - 1)
            while len(active):
                active = active[longer(self.common[bound[active]], self.common[active])]
                bound[active] = bound[bound[active]]
        return before, after


def branching_squares(array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that the next letter ends: branching tandem repeats.

    The boundary t of an interval of common prefix d has suffixes on both
    sides that agree in d letters only. For each suffix i of the smaller side
    it is asked whether i + d or i - d lies on the other: then d letters and
    the same again begin at the lesser.
    """
    before, after = array.bounds()
    at = np.flatnonzero(array.common > 0)
    sizes = np.minimum(at - before[at], after[at] - at)
    starts, periods = [], []
    # Boundaries in lots whose smaller sides have about CHECKED suffixes together.
    lots = np.flatnonzero(np.diff(np.cumsum(sizes) // CHECKED)) + 1
    for t, size in zip(np.split(at, lots), np.split(sizes, lots), strict=True):
        left_is_smaller = t - before[t] <= after[t] - t
        low = np.where(left_is_smaller, before[t], t)
        other_low = np.where(left_is_smaller, t, before[t])
        other_high = np.where(left_is_smaller, after[t], t)
        own = np.repeat(np.arange(len(t)), size)
        suffix = array.order[low[own] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)]
        depth = array.common[t][own]
        for partner in (suffix + depth, suffix - depth):
            place = array.place[np.maximum(partner, 0)]
            hit = (partner >= 0) & (place >= other_low[own]) & (place < other_high[own])
            starts.append(np.minimum(suffix, partner)[hit])
            periods.append(depth[hit])
    return np.concatenate(starts) if starts else np.zeros(0, np.int64), np.concatenate(periods) if periods else np.zeros(0, np.int64)


def runs_of(keys: np.ndarray, least: int = LEAST_RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence that ends in a letter of its own.

    A run ends in one branching square of its period; rotating it to the left,
    as far as letters a period apart are equal, leads to the run's start.
    Squares of a multiple of the period give the same run.
    """
    array = SuffixArray(keys)
    square, period = branching_squares(array)
    start = square - array.backward(square, square + period)
    end = square + 2 * period
    long = np.flatnonzero(end - start >= least)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[fresh], end[fresh], period[fresh]


def collapsed_texts(block: Block, doc: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[bytes]:
    """Each text's words joined by one space, without those that a run holds after its first period."""
    gone = np.zeros(len(block.words) + 1, np.int64)
    np.add.at(gone, block.first[doc] + start + period, 1)
    np.add.at(gone, block.first[doc] + end, -1)
    kept = np.cumsum(gone) == 0
    shorter = set(doc.tolist())
    data, texts = block.data.tobytes(), []
    for i in range(len(block.rows)):
        words = data[block.bounds[i] : block.bounds[i + 1]].split()
        if i in shorter:
            words = compress(words, kept[block.first[i] : block.first[i + 1]].tolist())
        texts.append(b" ".join(words))
    return texts
