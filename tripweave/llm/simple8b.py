"""Simple-8b: whole numbers packed into 64-bit words, several to a word.

The top four bits of a word are a selector, which says how many numbers of how
many bits its other 60 bits hold, the first one lowest. The escape selector
says that the next word is one number as it is. Numbers are packed in blocks
of `BLOCK`; each begins at a word of its own, so blocks decode side by side.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: numbers in a word and bits of each, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15

BLOCK = 1024


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word at which each block begins, and the places of escaped words.

    Each word takes as many of a block's next numbers as fit it. A block's last
    word may have room to spare, which holds zeros.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    blocks = -(-n // BLOCK)
    # Each block as a row, with zeros behind it, as its last word may have room to spare.
    row = BLOCK + int(COUNTS[0])
    full = n - n % BLOCK
    laid = np.zeros((blocks, row), np.uint64)
    laid[: full // BLOCK, :BLOCK] = ids[:full].reshape(-1, BLOCK)
    laid[-1, : n - full] = ids[full:] if full < n else laid[-1, : n - full]
    laid = laid.reshape(-1)
    choice = _widest_fit(laid)
    steps = np.append(COUNTS, [0] * (ESCAPE - len(COUNTS)) + [1])
    at = np.arange(blocks) * row
    end = at + BLOCK
    end[-1] = at[-1] + n - (blocks - 1) * BLOCK
    visited = []
    while len(at):
        visited.append(at)
        at = at + steps[choice[at]]
        more = at < end
        at, end = at[more], end[more]
    starts = np.sort(np.concatenate(visited))
    chosen = choice[starts]
    escaped = np.flatnonzero(chosen == ESCAPE)
    place = np.arange(len(starts)) + np.searchsorted(escaped, np.arange(len(starts)))
    words = np.zeros(len(starts) + len(escaped), np.uint64)
    words[place] = chosen.astype(np.uint64) << np.uint64(60)
    for selector, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist(), strict=True)):
        own = np.flatnonzero(chosen == selector)
        if not len(own):
            continue
        first = starts[own]
        total = words[place[own]]
        for i in range(count):
            total |= laid[first + i] << np.uint64(i * width)
        words[place[own]] = total
    words[place[escaped] + 1] = laid[starts[escaped]]
    offsets = place[np.searchsorted(starts, np.arange(blocks) * row)]
    return words, offsets.astype(np.uint32), (place[escaped] + 1).astype(np.uint32)


def _widest_fit(ids: np.ndarray) -> np.ndarray:
    """At each number, the selector that takes most of those from there on."""
    limits = np.uint64(1) << WIDTHS.astype(np.uint64)
    if ids.max() < 1 << 16:
        least = np.searchsorted(limits, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)[ids]
    else:
        least = np.searchsorted(limits, ids, side="right").astype(np.uint8)
    choice = np.full(len(ids), ESCAPE, np.uint8)
    most, covered = least.copy(), 1
    for selector in range(len(COUNTS) - 1, -1, -1):
        while covered < COUNTS[selector]:
            np.maximum(most[:-covered], least[covered:], out=most[:-covered])
            covered += 1
        choice[most <= selector] = selector
    return choice


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The `n` numbers of all blocks, decoded together."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[escapes] = True
    selector[raw] = -1
    held = np.where(selector == ESCAPE, 0, COUNTS[np.clip(selector, 0, len(COUNTS) - 1)])
    held[raw] = 1
    before = np.cumsum(held) - held
    block = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    first = before - before[offsets.astype(np.int64)][block] + block * BLOCK
    last = np.minimum((block + 1) * BLOCK, n)
    for kind, (count, width) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        own = np.flatnonzero(selector == kind)
        mask = np.uint64((1 << int(width)) - 1)
        for i in range(count if len(own) else 0):
            to = first[own] + i
            fits = to < last[own]
            out[to[fits]] = (words[own][fits] >> np.uint64(i * width)) & mask
    out[first[raw]] = words[raw]
    return out
