"""Runs by trying every period at every place."""

import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(doc, words):
    if doc is None or not words:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words, least=12):
    """(start, length, period) of all runs, by start, then period."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= 2 * p and length >= least:
                found.setdefault((i, i + length), p)
            i = j + 1
    return sorted((start, end - start, p) for (start, end), p in found.items())


def collapse(words, found):
    gone = {i for start, length, p in found for i in range(start + p, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)
