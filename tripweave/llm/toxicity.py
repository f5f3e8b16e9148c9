"""Toxicity of texts by a classifier that identity terms must not sway."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.columns import with_columns
from tripweave.llm.letters import Letters
from tripweave.llm.text import mix
from tripweave.llm.tokens import text_groups

# Labelled documents that the classifier is fitted on, about; drawn by a hash of their id.
TRAIN_DOCS = 20_000

# Features that the classifier knows, and documents of the sample that each must be in.
FEATURES = 2000
LEAST_DOCS = 5

# Chi-square from which a feature is taken to tell the kinds apart.
LEAST_STRAY = 6.63

# Letters of word beginnings that are features, beside whole words.
BEGINNINGS = (4, 5, 6)

# Groups of identity terms; within a group each may stand for the others.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("deaf", "blind", "disabled", "autistic"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden", "hindus"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs", "hindous"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos", "hindúes"),
)


def feature_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct features of each text and where each text's begin.

    Features are hashes of words (runs of letters, in lower case) and of the
    first 4, 5 and 6 letters of longer ones.
    """
    letters = Letters(texts)
    hashes, begin, end, first = letters.words()
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    kinds, owners = [hashes], [owner]
    for size in BEGINNINGS:
        longer = np.flatnonzero(end - begin > size)
        total = np.full(len(longer), size, np.uint64)
        for i in range(size):
            total = mix(total ^ letters.codes[begin[longer] + i])
        kinds.append(total)
        owners.append(owner[longer])
    values, owner = np.concatenate(kinds), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.searchsorted(owner[fresh], np.arange(len(texts) + 1))


@dataclass
class Swapper:
    """Makes counterfactual texts: each identity term becomes the next of its group."""

    groups: Sequence[Sequence[str]]

    def __post_init__(self):
        terms = {}
        for group in self.groups:
            for i, term in enumerate(group):
                terms.setdefault(term, group[(i + 1) % len(group)])
        self.terms = terms
        names = "|".join(map(re.escape, sorted(terms, key=len, reverse=True)))
        self.pattern = re.compile(rf"\b(?:{names})\b", re.IGNORECASE) if names else None

    def swap(self, text: str) -> str | None:
        """The text with every term swapped, or None if it has none."""
        if self.pattern is None or not self.pattern.search(text):
            return None
        return self.pattern.sub(lambda found: self.terms[found[0].lower()], text)


@dataclass
class ToxicityModel:
    """Logistic regression over the presence of features; `features` ascend."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        values, places = feature_sets(texts)
        total = np.zeros(len(values) + 1)
        if len(self.features):
            at = np.minimum(np.searchsorted(self.features, values), len(self.features) - 1)
            np.cumsum(np.where(self.features[at] == values, self.weights[at], 0.0), out=total[1:])
        logit = self.bias + total[places[1:]] - total[places[:-1]]
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = TRAIN_DOCS,
    identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    penalty: float = 1.0,
) -> ToxicityModel:
    """Fit to `labels` (doc_id, toxic) of `docs` (doc_id, text).

    Labels that are null, or of no document, count for nothing; of several for
    one id the highest counts. About `train_docs` labelled documents are
    drawn; that bounds what is broadcast and what comes to the driver: 2,000
    features, and which of them each drawn document has. A drawn text with
    identity terms also comes with its terms swapped, and `penalty` weighs the
    squared change of its logit. Without labels of both kinds, every score is
    the share of toxic labels.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, train_docs / max(count, 1)) * (1 << 30))
    # Bounded by the draw: some sixteen bytes for each of about `train_docs` rows.
    drawn = docs.select("doc_id", "text").join(F.broadcast(known.where(draw)), "doc_id")
    counted = (
        drawn.select("text", "toxic")
        .mapInArrow(_count_features, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    both = drawn.agg(F.sum(F.col("toxic")), F.count("*")).first()
    toxic, total = int(both[0] or 0), int(both[1])
    if not 0 < toxic < total:
        share = min(max(toxic / total if total else 0.0, 1e-9), 1 - 1e-9)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    # How far the feature's documents stray from the share of toxic ones, as a chi-square.
    seen = F.col("toxic") + F.col("clean")
    expected = seen * (toxic / total)
    strays = F.pow(F.col("toxic") - expected, 2) / (expected * (1 - toxic / total))
    telling = (seen >= LEAST_DOCS) & (strays >= LEAST_STRAY)
    best = counted.where(telling).orderBy(strays.desc(), "feature").limit(FEATURES).select("feature")
    features = np.sort(np.array([row.feature for row in best.collect()], np.int64).view(np.uint64))
    rows = (
        drawn.select("text", "toxic")
        .mapInArrow(_rows(features, Swapper(identity_terms)), "toxic int, own array<int>, swapped array<int>")
        .toPandas()
    )
    return _fit(features, rows.toxic.to_numpy(float), rows.own.tolist(), rows.swapped.tolist(), penalty)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, at = np.array(batch.column(1).to_pylist()), 0
        for group in text_groups(batch.column(0).to_pylist()):
            values, places = feature_sets(group)
            toxic = np.repeat(labels[at : at + len(group)] > 0, np.diff(places))
            at += len(group)
            distinct, inverse = np.unique(values, return_inverse=True)
            bad = np.bincount(inverse, toxic, len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(bad), pa.array(np.bincount(inverse, minlength=len(distinct)) - bad)],
                names=["feature", "toxic", "clean"],
            )


def _rows(features: np.ndarray, swapper: Swapper):
    def known(texts: list[str]) -> list[np.ndarray]:
        values, places = feature_sets(texts)
        out = []
        for i in range(len(texts)):
            out.append(np.flatnonzero(np.isin(features, values[places[i] : places[i + 1]])).astype(np.int32))
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(0).to_pylist()]
            own, swapped = [], []
            for group in text_groups(texts):
                own += known(group)
                others = [swapper.swap(text) for text in group]
                found = iter(known([other for other in others if other is not None]))
                swapped += [None if other is None else next(found) for other in others]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(x > 0) for x in batch.column(1).to_pylist()], pa.int32()),
                    pa.array(own, pa.list_(pa.int32())),
                    pa.array(swapped, pa.list_(pa.int32())),
                ],
                names=["toxic", "own", "swapped"],
            )

    return rows


def _fit(features, labels, own, swapped, penalty: float, turns: int = 400, decay: float = 1e-5) -> ToxicityModel:
    """Gradient steps (Adam) on log loss + penalty * (logit - counterfactual logit)^2."""
    n, width = len(labels), len(features)
    pairs = [i for i, other in enumerate(swapped) if other is not None]

    def laid(lists):
        rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return rows, np.concatenate([np.asarray(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)

    rows, columns = laid(own)
    other_rows, other_columns = laid([swapped[i] for i in pairs])
    pairs = np.array(pairs, np.int64)
    weights = np.zeros(width + 1)
    share = labels.mean()
    weights[-1] = np.log(share / (1 - share))
    slope, square = np.zeros(width + 1), np.zeros(width + 1)
    for turn in range(1, turns + 1):
        logit = np.bincount(rows, weights[columns], n) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels) / n
        gradient = np.append(np.bincount(columns, error[rows], width), error.sum())
        if len(pairs):
            other = np.bincount(other_rows, weights[other_columns], len(pairs)) + weights[-1]
            change = 2 * penalty * (logit[pairs] - other) / n
            by_row = np.zeros(n)
            by_row[pairs] = change
            gradient[:-1] += np.bincount(columns, by_row[rows], width)
            gradient[:-1] -= np.bincount(other_columns, change[other_rows], width)
        gradient[:-1] += decay * weights[:-1]
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= 0.1 * (slope / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return ToxicityModel(features, weights[:-1], float(weights[-1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Add score (0 to 1, higher: likelier toxic) to `docs` (text and any other columns).

    A null text is scored as an empty one; both get the classifier's bias. A
    column named score is replaced.
    """

    def scored(texts: pa.Array) -> list[pa.Array]:
        scores = [model.score(group) for group in text_groups(texts.to_pylist())]
        return [pa.array(np.concatenate([np.zeros(0), *scores]))]

    return with_columns(docs, {"score": "double"}, scored)
