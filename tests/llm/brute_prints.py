"""The embedding step by step, and documents next to each other by sorting them."""

import hashlib

import numpy as np

from tripweave.llm import edit_prints as ep


def coins():
    return np.random.RandomState(12).randint(0, 2, (ep.WALKS, ep.CLASSES, ep.PERIOD)).astype(bool)


def embedding(letters, moves):
    """The class of the character that the walk stands on at each time."""
    out, i, time = [], 0, 0
    while i < len(letters):
        out.append(letters[i])
        i += moves[letters[i], time % ep.PERIOD]
        time += 1
    return out


def fingerprint(text, moves):
    letters, bits = ep.letters_of(text).tolist(), []
    for walk in range(ep.WALKS):
        stood = embedding(letters, moves[walk])
        for sample in range(walk * ep.SAMPLES, (walk + 1) * ep.SAMPLES):
            time = max((t for t in ep._records()[sample].tolist() if t < len(stood)), default=None)
            bits.append(ep._signs()[sample, ep.CLASSES if time is None else stood[time]])
    return np.packbits(np.array(bits, np.uint8)).tobytes()


def likeness(a, b):
    unequal = sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True))
    return max(0.0, 1 - 2 * unequal / ep.BITS)


def bands(print_):
    bits = np.unpackbits(np.frombuffer(print_, np.uint8))
    return [tuple(bits[places].tolist()) for places in ep._band_places()]


def compared(rows):
    """What `compare_with_next` returns of (doc_id, text) with distinct ids, but for the fingerprints."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    prints = {}

    def of(text):
        return prints.setdefault(text, ep.fingerprints([text])[0].tobytes())

    for (doc, text), (_, following) in zip(ordered, [*ordered[1:], *ordered[:1]], strict=True):
        text, following = text or "", following or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        shared = [sum(x == y for x, y in zip(bands(of(text)), bands(of(other)), strict=True)) for other in (changed, following)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        likes = likeness(of(text), of(changed)), likeness(of(text), of(following))
        yield (doc, len(text), digest, of(text).hex(), of(changed).hex(), *likes, *shared)
