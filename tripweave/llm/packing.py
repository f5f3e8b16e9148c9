"""Documents packed into training sequences of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.text import blocks
from tripweave.llm.tokens import END_ID, encoder, vocabulary
from tripweave.session import store

SEQUENCE = 1024

# Windows a partition keeps open.
OPEN_WINDOWS = 16

# A gap of fewer ids is padded; a larger one is filled with part of the next document.
LEAST_CUT = 8

# Partitions, or groups of them, whose open windows one task merges.
MERGED = 64

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, "
    "sequence_id long, offset long, home long, is_open boolean"
)
_NAMES = [part.split()[0] for part in PIECES.split(", ")]


@dataclass
class _Window:
    """A sequence in the making."""

    held: int = 0
    pieces: list[tuple] = field(default_factory=list)

    def put(self, doc_id, start: int, doc_tokens: int, ids: bytes) -> None:
        length = len(ids) // 4
        self.pieces.append((doc_id, start, length, doc_tokens, ids, self.held))
        self.held += length


class Packer:
    """Bounded-space best fit: at most `windows` sequences are open at a time."""

    def __init__(self, home: int, first_sequence: int, size: int, windows: int, least_cut: int):
        self.home, self.next = home, first_sequence
        self.size, self.windows, self.least_cut = size, windows, least_cut
        self.open: list[_Window] = []
        self.rows: list[tuple] = []

    def emit(self, window: _Window, is_open: bool = False) -> None:
        for doc_id, start, length, doc_tokens, ids, offset in window.pieces:
            self.rows.append((doc_id, start, length, doc_tokens, ids, self.next, offset, self.home, is_open))
        self.next += 1

    def add(self, doc_id, start: int, doc_tokens: int, ids: bytes) -> None:
        """Place ids that begin at `start` of a document, cut where a sequence is full."""
        while len(ids) >= 4 * self.size:
            whole = _Window()
            whole.put(doc_id, start, doc_tokens, ids[: 4 * self.size])
            self.emit(whole)
            ids, start = ids[4 * self.size :], start + self.size
        while ids:
            length = len(ids) // 4
            room = [w for w in self.open if self.size - w.held >= length]
            if room:
                window = max(room, key=lambda w: w.held)
            elif len(self.open) < self.windows:
                window = _Window()
                self.open.append(window)
            else:
                # None fits: the fullest goes, filled up if the gap is worth a cut.
                window = max(self.open, key=lambda w: w.held)
                gap = self.size - window.held
                if gap >= self.least_cut:
                    window.put(doc_id, start, doc_tokens, ids[: 4 * gap])
                    ids, start = ids[4 * gap :], start + gap
                self.open.remove(window)
                self.emit(window)
                continue
            window.put(doc_id, start, doc_tokens, ids)
            ids = b""
            if window.held == self.size:
                self.open.remove(window)
                self.emit(window)

    def close(self, last: bool) -> None:
        """Hand over the open windows; after the `last` merge, close them for good.

        Then what they hold is put end to end and cut into full sequences, and
        what remains into sequences of powers of two, which take no padding.
        """
        if not last:
            for window in self.open:
                self.emit(window, is_open=True)
            self.open = []
            return
        pieces = [(piece[0], piece[1], piece[3], piece[4]) for window in self.open for piece in window.pieces]
        left = sum(window.held for window in self.open)
        self.open = []
        window, room = None, 0
        for doc_id, start, doc_tokens, ids in pieces:
            while ids:
                if window is None:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                    window = _Window()
                part = ids[: 4 * (room - window.held)]
                window.put(doc_id, start, doc_tokens, part)
                ids, start, left = ids[len(part) :], start + len(part) // 4, left - len(part) // 4
                if window.held == room:
                    self.emit(window)
                    window = None

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NAMES]
        types = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=_NAMES
        )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    windows: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
    end_id: int = END_ID,
) -> DataFrame:
    """Pack `docs` (doc_id, text) into sequences of `size` ids, one row per piece.

    A document is its text's ids and `end_id`; a null text is empty, and a row
    is a document whether or not its doc_id is null or repeated. Each
    partition of the input packs what it reads, without a shuffle, and keeps
    `windows` sequences open. What stays open is merged by groups of
    partitions, round by round, and only that moves. The pieces are written
    to the work folder once, as closed and open ones are read apart.

    Returns doc_id, start, length, doc_tokens, ids (little-endian unsigned
    32-bit), sequence_id and offset.
    """
    model = vocabulary(tokenizer)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId()
        own = encoder(model)
        packer = Packer(home, home << 32, size, windows, least_cut)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                for row, ids in zip(block.rows, own.encode(block), strict=True):
                    packer.add(doc_ids[row], 0, len(ids) // 4 + 1, ids + end)
                if packer.rows:
                    yield packer.take()
        packer.close(last=False)
        yield packer.take()

    pieces = store(docs.select("doc_id", "text").mapInArrow(packed, PIECES), "packed")
    done = pieces.where(~F.col("is_open"))
    left = pieces.where("is_open")
    homes = (pieces.agg(F.max("home")).first()[0] or 0) + 1
    turn = 1
    while True:
        last = homes <= MERGED
        merged = (
            left.withColumn("home", F.expr(f"home div {MERGED}"))
            .groupBy("home")
            .applyInPandas(_merge(turn, last, size, windows, least_cut), PIECES)
        )
        if last:
            done = done.unionByName(merged)
            return done.drop("home", "is_open")
        merged = store(merged, "merged")
        done = done.unionByName(merged.where(~F.col("is_open")))
        left = merged.where("is_open")
        homes = -(-homes // MERGED)
        turn += 1


def _merge(turn: int, last: bool, size: int, windows: int, least_cut: int):
    """Pack the pieces of some partitions' open windows anew, the longest first."""

    def merge(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        home = int(key[0])
        packer = Packer(home, (turn << 56) + (home << 32), size, windows, least_cut)
        order = ["length", "sequence_id", "offset"]
        for row in pieces.sort_values(order, ascending=[False, True, True]).itertuples(index=False):
            doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
            packer.add(doc_id, int(row.start), int(row.doc_tokens), bytes(row.ids))
        packer.close(last)
        return packer.take().to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)

    return merge
