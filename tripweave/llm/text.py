"""Word and shingle hashes of whole Arrow batches, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words are maximal runs of bytes other than these: [^\x20\x09-\x0D]+.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

# Bytes of text that are hashed at a time; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODES = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, BLOCK_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Block:
    """Some whole documents of a batch: their bytes, words and word hashes.

    `first[i]` is the position of document i's first word, `first[i + 1]` one
    past its last. `begin` and `end` are the words' places in `data`.
    """

    def __init__(self, rows: range, data: np.ndarray, bounds: np.ndarray, lower: bool):
        self.rows = rows
        self.data = data
        self.bounds = bounds
        if lower:
            data = _LOWER[data]
        inside = _IN_WORD[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, bounds)
        powers, inverses = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * powers[: len(data)], out=sums[1:])
        self.words = mix((sums[self.end] - sums[self.begin]) * inverses[self.begin])

    @property
    def counts(self) -> np.ndarray:
        """Words of each document."""
        return np.diff(self.first)

    def shingles(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words, and where each document's begin.

        With `short`, a document of fewer words, but some, has one run of all of them.
        """
        counts = self.counts
        runs = np.maximum(counts - size + 1, 0)
        hashes = run_hashes(self.words, size)
        last = np.repeat(self.first[1:], counts)
        kept = hashes[np.flatnonzero(np.arange(len(last)) + size <= last)] if len(hashes) else hashes
        places = np.concatenate([[0], np.cumsum(runs)])
        few = np.flatnonzero((counts > 0) & (counts < size)) if short else ()
        if len(few):
            alone = np.array(
                [run_hashes(self.words[self.first[i] : self.first[i + 1]], counts[i])[0] for i in few],
                np.uint64,
            )
            kept = np.insert(kept, places[few], alone)
            runs[few] = 1
            places = np.concatenate([[0], np.cumsum(runs)])
        return kept, places


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` consecutive word hashes, at its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total = total * _BASE + words[i : i + n]
    return mix(total)


def large_binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Text as bytes; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def blocks(column: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a text column in blocks of about `size` bytes."""
    column = large_binary(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield Block(
            range(row, stop),
            data[offsets[row] : offsets[stop]],
            offsets[row : stop + 1] - offsets[row],
            lower,
        )
        row = stop


def count_words(column: pa.Array) -> int:
    """Words of all documents of a text column."""
    column = large_binary(column)
    if not len(column):
        return 0
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return 0
    inside = _IN_WORD[np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[1:-1] - offsets[0]
    edges = edges[edges < len(inside)]
    opens[edges] = inside[edges]
    return int(np.count_nonzero(opens))
