"""Token ids of texts, by a tokenizer file, for use inside tasks."""

from __future__ import annotations

import os

import numpy as np

from tripweave.llm.text import Block, mix

# Words whose ids a worker keeps; with more, it starts anew. Ids of them that it keeps.
KEPT_WORDS = 1_200_000
KEPT_IDS = 16_000_000

# Words that are encoded as one text, and such texts at a time.
WORDS_A_LINE = 50
LINES = 200

END_ID = 0

# How a word is joined to what stands before it: nothing, a space, a line break.
_BARE, _SPACED, _BROKEN = 0, 1, 2
_JOINS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], np.uint64)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
_OTHER_BLANK = np.zeros(256, bool)
_OTHER_BLANK[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def vocabulary(path: str) -> str:
    """The tokenizer file's content: a bounded file, read once and shipped to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Table:
    """Rows by 64-bit key, looked up and entered many at a time."""

    def __init__(self, rows: int):
        self.size = 1 << int(2 * rows).bit_length()
        self.keys = np.zeros(self.size, np.uint64)
        self.rows = np.full(self.size, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        while len(left):
            rows = self.rows[at]
            same = self.keys[at] == keys[left]
            out[left[same]] = rows[same]
            on = ~same & (rows >= 0)
            left, at = left[on], (at[on] + 1) & (self.size - 1)
        return out

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Enter distinct keys that aren't there."""
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.rows[at] < 0)
            self.rows[at[free]] = rows[free]
            self.keys[at[free]] = keys[free]
            on = self.rows[at] != rows
            keys, rows, at = keys[on], rows[on], (at[on] + 1) & (self.size - 1)


class Encoder:
    """Encodes texts as the tokenizer does, each distinct word once.

    A byte-level vocabulary of this kind never joins across the place before
    a single space or around a single line break. Texts whose white space is
    made of those alone are cut there and put together from their words' ids,
    which are kept by a 64-bit hash; any other text goes through the tokenizer
    whole. Strings of special tokens are ordinary text.
    """

    def __init__(self, model: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        self.kept = kept
        line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = line_break[0] if len(line_break) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.table = _Table(self.kept)
        self.starts = np.zeros(self.kept + 1, np.int64)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.words = self.used = 0

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, block: Block) -> list[bytes]:
        """The ids of each text of a block, as little-endian unsigned 32-bit integers."""
        odd = self._unevenly_spaced(block)
        before = block.data[block.begin - 1]
        join = np.where(before == 0x20, _SPACED, _BROKEN)
        join[block.begin == block.bounds[:-1][np.searchsorted(block.bounds, block.begin, side="right") - 1]] = _BARE
        keys = mix(block.words ^ _JOINS[join])
        use = np.repeat(~odd, block.counts)
        at = np.flatnonzero(use)
        ids, found = self._word_ids(block, keys, join, at)
        size = np.zeros(len(keys), np.int64)
        size[at] = found
        ends = np.cumsum(size)
        data = ids.astype("<u4").tobytes()
        edges = 4 * np.concatenate([[0], ends])[block.first]
        out = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd):
            out[i] = self.whole(block.data[block.bounds[i] : block.bounds[i + 1]].tobytes().decode())
        return out

    def _word_ids(self, block: Block, keys: np.ndarray, joins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at `at`, one word after the other, and how many each has."""
        rows = self.table.find(keys[at])
        new = at[rows < 0]
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            if self.words + len(distinct) > self.kept or self.used > KEPT_IDS:
                distinct, first = np.unique(keys[at], return_index=True)
                if len(distinct) > self.kept:
                    # One text may have more words than are kept: then part by part.
                    parts = [at[i : i + self.kept] for i in range(0, len(at), self.kept)]
                    ids, sizes = zip(*[self._word_ids(block, keys, joins, part) for part in parts], strict=True)
                    return np.concatenate(ids), np.concatenate(sizes)
                self._forget()
                new = at
            self._learn(block, distinct, new[first], joins[new[first]])
            rows = self.table.find(keys[at])
        begin = self.starts[rows]
        size = self.starts[rows + 1] - begin
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(begin - ends + size, size) + np.arange(total)], size

    def _unevenly_spaced(self, block: Block) -> np.ndarray:
        """Texts with white space other than single spaces and line breaks, or with any at the end."""
        if self.line_break is None:
            return np.ones(len(block.rows), bool)
        data, bounds = block.data, block.bounds
        blank = _BLANK[data]
        bad = _OTHER_BLANK[data]
        twice = blank[1:] & blank[:-1]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        twice[edges - 1] = False
        bad[1:] |= twice
        last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        bad[last] |= blank[last]
        lead = np.flatnonzero(_WIDE_LEAD[data])
        if len(lead):
            padded = np.concatenate([data, np.zeros(2, np.uint8)])
            code = (padded[lead].astype(np.int32) << 16) | (padded[lead + 1].astype(np.int32) << 8) | padded[lead + 2]
            pair = code >> 8
            wide = (pair == 0xC285) | (pair == 0xC2A0) | (code == 0xE19A80) | (code == 0xE38080) | (code == 0xE2819F)
            wide |= (code >= 0xE28080) & (code <= 0xE2808A) | (code == 0xE280A8) | (code == 0xE280A9) | (code == 0xE280AF)
            bad[lead[wide]] = True
        count = np.concatenate([[0], np.cumsum(bad)])
        return count[bounds[1:]] > count[bounds[:-1]]

    def _learn(self, block: Block, keys: np.ndarray, at: np.ndarray, joins: np.ndarray) -> None:
        """Encode words, some together, each followed by a line break, and note their ids."""
        data = block.data.tobytes()
        spans = zip(block.begin[at].tolist(), block.end[at].tolist(), joins.tolist(), strict=True)
        spelt = [(" " if join == _SPACED else "") + data[a:b].decode() + "\n" for a, b, join in spans]
        size = WORDS_A_LINE * LINES
        for i in range(0, len(spelt), size):
            part = spelt[i : i + size]
            lines = ["".join(part[j : j + WORDS_A_LINE]) for j in range(0, len(part), WORDS_A_LINE)]
            found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(line.ids, np.uint32) for line in found])
            # A word after a line break takes the break's id that ends the word before it.
            stops = np.flatnonzero(ids == self.line_break)
            starts = np.concatenate([[0], stops[:-1] + 1])
            broken = joins[i : i + size] == _BROKEN
            sizes = stops - starts + broken
            ends = np.cumsum(sizes)
            total = int(ends[-1])
            source = np.repeat(starts - broken - ends + sizes, sizes) + np.arange(total)
            taken = np.concatenate([[self.line_break], ids]).astype(np.uint32)[source + 1]
            while self.used + total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
            self.ids[self.used : self.used + total] = taken
            rows = np.arange(self.words, self.words + len(part))
            self.starts[rows + 1] = self.used + ends
            self.table.add(keys[i : i + size], rows.astype(np.int32))
            self.words += len(part)
            self.used += total


_encoders: dict[str, Encoder] = {}


def encoder(model: str) -> Encoder:
    """This worker's encoder of a tokenizer file's content; tasks that follow find its words known."""
    if model not in _encoders:
        _encoders.clear()
        _encoders[model] = Encoder(model)
    return _encoders[model]


def text_groups(texts: list[str | None], size: int = 1 << 19):
    """Runs of texts of about `size` characters together, null as empty."""
    group, held = [], 0
    for text in texts:
        text = text or ""
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group
