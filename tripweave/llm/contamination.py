"""Test items inside documents, by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.columns import with_columns
from tripweave.llm.letters import Letters
from tripweave.llm.text import mix, run_hashes
from tripweave.llm.tokens import text_groups
from tripweave.llm.workers import find_library

SHINGLE = 5
LEAST_PERCENT = 80

# Hash functions of an item's sketch, and how many of the minima a document must hold to be checked.
# Of an item contained by 80 %, fewer are there with a chance of 1e-6.
HASHES = 32
LEAST_MINIMA = 13

# Shingles of the items that are searched for in one pass over the documents.
PASS_SHINGLES = 2_000_000

_FACTORS = np.random.RandomState(13).randint(1, 1 << 62, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)

MARK = "holds a test item"

HITS = "doc_id long, item_id long, n_common long, n_item long, first_word long, last_word long"


def shingle_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of five words of each text, in order, and where each text's begin.

    Words are runs of letters and digits in lower case. A text of one to four
    words is one run; one without words has none.
    """
    hashes, _, _, first = Letters(texts, digits=True).words()
    runs = run_hashes(hashes, SHINGLE)
    out, places = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(runs[a : b - SHINGLE + 1])
        elif b > a:
            out.append(run_hashes(hashes[a:b], b - a))
        else:
            out.append(runs[:0])
        places.append(places[-1] + len(out[-1]))
    return np.concatenate([runs[:0], *out]), np.array(places)


@dataclass
class ItemIndex:
    """Sketches of items, in partitions of items of like size.

    A partition holds items of 2^k to 2^(k+1) - 1 shingles. Each item's
    minimum under a hash function is a shingle of its own, so a document holds
    about as large a share of the minima as of the item, however long it is.
    With `inside`, items of fewer than five words are no sketches but runs of
    their own length, which `find_short` looks for.
    """

    ids: np.ndarray
    sets: list[np.ndarray]
    partitions: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids: list[int], texts: list[str], inside: bool = True) -> ItemIndex:
        runs, places = shingle_runs(texts)
        lengths = np.diff(Letters(texts, digits=True).words()[3])
        short = {}
        for length in range(1, SHINGLE) if inside else ():
            items = np.flatnonzero(lengths == length)
            if len(items):
                values = runs[places[items]]
                order = np.argsort(values, kind="stable")
                short[length] = values[order], items[order]
        sets = [np.unique(runs[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]
        classes: dict[int, list[tuple[int, int, int]]] = {}
        for item, own in enumerate(sets):
            if not len(own) or (inside and lengths[item] < SHINGLE):
                continue
            least = [own[np.argmin(mix(own * factor))] for factor in _FACTORS]
            values, times = np.unique(np.array(least, np.uint64), return_counts=True)
            rows = classes.setdefault(len(own).bit_length() - 1, [])
            rows += [(int(value), item, int(n)) for value, n in zip(values, times, strict=True)]
        partitions = []
        for size, rows in sorted(classes.items()):
            rows.sort()
            columns = list(zip(*rows, strict=True))
            partitions.append(
                (1 << size, np.array(columns[0], np.uint64), np.array(columns[1]), np.array(columns[2]))
            )
        return cls(np.array(ids, np.int64), sets, partitions, short)

    def find(self, runs: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, common, size, first, last run that is common) of each text's items."""
        out = []
        if not len(runs):
            return out
        marks = self._marks()
        near = np.flatnonzero(marks[runs >> np.uint64(44)])
        owner = np.searchsorted(places, near, side="right") - 1
        sizes = np.diff(places)
        for least, values, items, times in self.partitions:
            # A text must have room for 80 % of the partition's least item.
            fits = 100 * sizes[owner] >= LEAST_PERCENT * least
            at, who = near[fits], owner[fits]
            low = np.searchsorted(values, runs[at], side="left")
            many = np.searchsorted(values, runs[at], side="right") - low
            hit = np.flatnonzero(many)
            if not len(hit):
                continue
            row = np.repeat(low[hit], many[hit]) + np.arange(many[hit].sum()) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit])
            text = np.repeat(who[hit], many[hit])
            # Each minimum of an item counts once for a text.
            seen = np.unique(text.astype(np.int64) * len(values) + row)
            text, row = seen // len(values), seen % len(values)
            pairs, inverse = np.unique(text * len(self.ids) + items[row], return_inverse=True)
            found = np.bincount(inverse, times[row])
            for pair in pairs[found >= LEAST_MINIMA].tolist():
                text, item = divmod(pair, len(self.ids))
                own = self.sets[item]
                inside = np.flatnonzero(np.isin(runs[places[text] : places[text + 1]], own))
                common = len(np.unique(runs[places[text] + inside]))
                if 100 * common >= LEAST_PERCENT * len(own):
                    out.append((text, item, common, len(own), int(inside[0]), int(inside[-1])))
        return out

    def find_short(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, items, first words, last words) of the items that are runs of fewer than five words."""
        if not self.short:
            return
        hashes, _, _, first = Letters(texts, digits=True).words()
        ends = np.repeat(first[1:], np.diff(first))
        for length, (values, items) in self.short.items():
            runs = run_hashes(hashes, length)
            at = np.flatnonzero(np.arange(len(runs)) + length <= ends[: len(runs)])
            low = np.searchsorted(values, runs[at], side="left")
            many = np.searchsorted(values, runs[at], side="right") - low
            row = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(at, many)
            text = np.searchsorted(first, at, side="right") - 1
            # Occurrences come in the order of the texts, so the first and the last of a pair are its bounds.
            pair = text.astype(np.int64) * len(self.ids) + items[row]
            found, start = np.unique(pair, return_index=True)
            stop = len(pair) - 1 - np.unique(pair[::-1], return_index=True)[1]
            text = found // len(self.ids)
            yield text, found % len(self.ids), at[start] - first[text], at[stop] - first[text] + length - 1

    def _marks(self) -> np.ndarray:
        """The leading 20 bits of all minima, to pass over most shingles at once."""
        if not hasattr(self, "_marked"):
            self._marked = np.zeros(1 << 20, bool)
            for _, values, _, _ in self.partitions:
                self._marked[values >> np.uint64(44)] = True
        return self._marked


def find_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold at least 80 % of a test item's shingles.

    `docs` has doc_id and text, `items` item_id and text. A shingle is five
    words; an item of fewer words is one shingle of its own length, which is
    found wherever it stands in a text. Returns one row per pair: doc_id,
    item_id, n_common and n_item (distinct shingles), containment, and the
    first and last word of the document's part. Texts that are null or have
    no words hold nothing and are held by nothing; items without an id are
    left out; a repeated row of `docs` is searched again, a repeated item_id
    counts once for each distinct text.

    Items are indexed in blocks of about two million shingles, each block is
    shipped to the tasks and the documents are read once for it; documents
    aren't shuffled. The number of blocks grows with the items, the size of
    one doesn't.
    """
    find_library(docs.sparkSession)
    found = None
    for index in _indexes(items, True):
        hits = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_search(index), HITS)
        found = hits if found is None else found.unionByName(hits)
    return found.withColumn("containment", F.col("n_common") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, items: DataFrame, short_inside: bool = False) -> DataFrame:
    """The rows of `docs` that hold no test item, with all their columns.

    As `find_contamination` finds them, but an item of fewer than five words
    drops only a text that has no other words, as it would be in many clean
    ones; with `short_inside` it drops all that hold it. Documents are judged
    where they are read and don't move; null and empty texts stay, and a
    repeated row stays or goes like the first.
    """
    find_library(docs.sparkSession)
    for index in _indexes(items, short_inside):
        docs = with_columns(docs, {MARK: "boolean"}, _holds(index)).where(~F.col(MARK)).drop(MARK)
    return docs


def _indexes(items: DataFrame, inside: bool) -> Iterator[ItemIndex]:
    given = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    letters = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(letters) // (PASS_SHINGLES * 5)))
    for i in range(blocks):
        block = given.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        yield ItemIndex.of([row.item_id for row in block], [row.text for row in block], inside)


def _holds(index: ItemIndex):
    def holds(texts: pa.Array) -> list[pa.Array]:
        marks = []
        for group in text_groups(texts.to_pylist()):
            found = {row[0] for row in index.find(*shingle_runs(group))}
            for texts_held, *_ in index.find_short(group):
                found.update(texts_held.tolist())
            marks += [i in found for i in range(len(group))]
        return [pa.array(marks, pa.bool_())]

    return holds


def _search(index: ItemIndex):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, rows = batch.column(0).to_pylist(), 0, []
            for group in text_groups(batch.column(1).to_pylist()):
                runs, places = shingle_runs(group)
                for text, item, common, size, first, last in index.find(runs, places):
                    rows.append((ids[at + text], int(index.ids[item]), common, size, first, last + SHINGLE - 1))
                for found in index.find_short(group):
                    for text, item, first, last in zip(*(part.tolist() for part in found), strict=True):
                        rows.append((ids[at + text], int(index.ids[item]), 1, 1, first, last))
                at += len(group)
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns],
                names=[field.split()[0] for field in HITS.split(", ")],
            )

    return search
