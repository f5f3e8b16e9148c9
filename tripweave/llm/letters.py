"""Letters of whole batches of texts as numpy arrays, for use inside tasks."""

from __future__ import annotations

from functools import cache

import numpy as np

from tripweave.llm.text import mix

SPACE = 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@cache
def _is_letter(digits: bool) -> np.ndarray:
    test = str.isalnum if digits else str.isalpha
    return np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        tables.append(np.multiply.accumulate(steps))
    return tables[0], tables[1]


class Letters:
    """Texts in lower case, with every run of other characters as one space.

    `codes` holds all texts with a space before, between and after them;
    text i lies from the space at `edge[i]` to the one at `edge[i + 1]`. With
    `digits`, letters and digits count alike.
    """

    def __init__(self, texts: list[str], digits: bool = False):
        lowered = [text.lower() for text in texts]
        raw = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
        inside = _is_letter(digits)[raw]
        kept = inside.copy()
        kept[0] = True
        kept[1:] |= inside[:-1]
        self.codes = np.where(inside, raw, SPACE)[kept].astype(np.uint64)
        marks = np.concatenate([[0], np.cumsum(np.array([len(text) + 1 for text in lowered], np.int64))])
        self.edge = np.cumsum(kept)[marks] - 1

    def has_letter(self) -> np.ndarray:
        return np.diff(self.edge) > 0

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` characters, and where each text's begin."""
        counts = np.maximum(np.diff(self.edge) - size + 2, 0)
        places = np.concatenate([[0], np.cumsum(counts)])
        n = len(self.codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), places
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total = total * _BASE + self.codes[i : i + n]
        own = np.arange(places[-1]) + np.repeat(self.edge[:-1] - places[:-1], counts)
        return mix(total[own]), places

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, begin and end in `codes` of each word, and where each text's words begin."""
        inside = self.codes != SPACE
        begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        size = 1 << max(16, int(len(self.codes) + 1).bit_length())
        powers, inverses = _powers(size)
        sums = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(mix(self.codes) * powers[: len(self.codes)], out=sums[1:])
        hashes = mix((sums[end] - sums[begin]) * inverses[begin])
        return hashes, begin, end, np.searchsorted(begin, self.edge)
