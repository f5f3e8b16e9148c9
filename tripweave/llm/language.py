"""Language of texts by bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripweave.llm.columns import with_columns
from tripweave.llm.letters import Letters
from tripweave.llm.text import mix
from tripweave.llm.tokens import text_groups

UNKNOWN = "und"

GRAM = 4

# Labelled documents of a language that its filter is made from, about; drawn by a hash of their id.
TRAIN_DOCS = 2000

# An n-gram enters a language's filter if it makes up this share of the sample's; so there are 50,000 at most.
LEAST_SHARE = 2e-5
LEAST_COUNT = 2

PROBES = 4

# Slots for each n-gram of the fullest filter.
ROOM = 12


def held_out(doc_id: Column) -> Column:
    """The quarter of documents that no label is learnt from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class LanguageFilters:
    """One Bloom filter per language, cut into slices: `slots[i]` has bit i of every filter.

    So one probe answers for all languages at once. Languages are in order of
    their documents, so that of equal ones the most common is chosen.
    """

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def of(cls, languages: list[str], grams: list[np.ndarray]) -> LanguageFilters:
        size = 1 << int(ROOM * max([1, *map(len, grams)])).bit_length()
        slots = np.zeros((size, max(1, -(-len(languages) // 8))), np.uint8)
        for i, own in enumerate(grams):
            for probe in range(PROBES):
                slots[_slot(own, probe, size), i // 8] |= np.uint8(1 << i % 8)
        bits = np.unpackbits(slots, axis=1, bitorder="little")[:, : len(languages)]
        return cls(languages, slots, bits.mean(axis=0) ** PROBES)

    def rates(self, grams: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Share of each text's n-grams that each language has, less the expected false ones."""
        found = self.slots[_slot(grams, 0, len(self.slots))]
        for probe in range(1, PROBES):
            found = found & self.slots[_slot(grams, probe, len(self.slots))]
        out = np.zeros((len(places) - 1, len(self.languages)))
        counts = np.diff(places)
        full = np.flatnonzero(counts)
        if len(full):
            bits = np.unpackbits(found, axis=1, bitorder="little")[:, : len(self.languages)]
            hits = np.add.reduceat(bits, places[full], axis=0, dtype=np.int64) / counts[full, None]
            out[full] = np.clip((hits - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)
        return out


def _slot(grams: np.ndarray, probe: int, size: int) -> np.ndarray:
    return (mix(grams + np.uint64(probe)) & np.uint64(size - 1)).astype(np.int64)


def fit_language_filters(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageFilters:
    """Filters from `labelled` (doc_id, text, lang); rows without any of these count for nothing.

    About `train_docs` documents of each language are drawn, and n-grams are
    counted over their whole texts. To the driver come the counts of documents
    by language and at most 50,000 n-grams of each.
    """
    known = labelled.where("doc_id is not null and text is not null and lang is not null")
    docs = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not docs:
        return LanguageFilters.of([], [])
    share = F.create_map(*[F.lit(x) for row in docs for x in (row.lang, min(1.0, train_docs / row["count"]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    counted = (
        known.where(draw)
        .select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # Totals are as many rows as there are languages.
    total = {row.lang: row.n for row in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*[F.lit(x) for k, n in total.items() for x in (k, max(LEAST_COUNT, n * LEAST_SHARE))]) if total else None
    grams = counted.where(F.col("n") >= least[F.col("lang")]).toPandas() if total else None
    names = [row.lang for row in docs]
    own = [
        np.sort(grams.gram[grams.lang == name].to_numpy(np.int64)).view(np.uint64) if total else np.zeros(0, np.uint64)
        for name in names
    ]
    return LanguageFilters.of(names, own)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_language.setdefault(lang, []).append(text)
        for lang, texts in by_language.items():
            for group in text_groups(texts):
                values, counts = np.unique(Letters(group).grams(GRAM)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )


def predict_language(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """Add lang_pred and score (0 to 1) to `docs` (text and any other columns).

    The score is the corrected share of the text's n-grams that the predicted
    language's filter has. A text that is null or without a letter gets `und`
    and 0, as does every text if there was nothing to learn from; a text too
    short for an n-gram gets the most common language and 0. Columns of these
    names are replaced.
    """

    def predicted(texts: pa.Array) -> list[pa.Array]:
        names, scores = [], []
        for group in text_groups(texts.to_pylist()):
            letters = Letters(group)
            if not filters.languages:
                names += [UNKNOWN] * len(group)
                scores += [0.0] * len(group)
                continue
            rates = filters.rates(*letters.grams(GRAM))
            best = rates.argmax(axis=1)
            sure = letters.has_letter()
            names += [filters.languages[i] if ok else UNKNOWN for i, ok in zip(best, sure, strict=True)]
            scores += np.where(sure, rates[np.arange(len(group)), best], 0.0).tolist()
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return with_columns(docs, {"lang_pred": "string", "score": "double"}, predicted)
