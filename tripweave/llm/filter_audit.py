"""How text filters overlap: survival words of documents, counted by carry-save adders."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.text import Block, blocks, mix
from tripweave.llm.workers import find_library
from tripweave.session import store

# Filter i of the audit is bit i of `fails`; a document fails it if the condition holds.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)

# Filter A: fewer words. B: per cent of distinct words below. C: per cent of A-Z above. D: any of these signs.
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
SIGNS = b"#$%&*|"
REPEATED = FILTERS.index("E")

_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS)] = True
_BITS = np.arange(SUBSETS, dtype=np.uint32)

# The survival word of each combination of failed filters: bit s is set if a
# document that fails these passes all filters of subset s.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], np.uint32)

STEPS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
]


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """What each filter removes at each step of every order of the filters, per part.

    `docs` has doc_id, text and the column that names a row's part; `labels`
    has doc_id, quality and toxic. A null text is empty, a null part is the
    empty string. Filter E finds texts that a smaller doc_id has, whatever
    other filters say: rows that share the smallest id of a text all pass, and
    a null id is neither smaller nor greater than another. Several labels of
    one id count if any of them is 1; rows of one id all have its labels, a
    null id has none. Repeated rows count each. No rows without documents.
    """
    return order_steps(subset_survivors(labelled_failures(docs, labels, part)))


def labelled_failures(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, fails, good, toxic) of every document; what the filters say of a text is stored."""
    find_library(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    failing = store(given.mapInArrow(_failures, "doc_id long, part string, digest binary, fails int"), "failures")
    # Stored, so that the joins read plain shuffles, whose hot keys Spark can split.
    first = store(failing.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "first-texts")
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    said = store(said, "labels")
    # A text's first row is met by text and id, so copies of one text don't meet in one task.
    known = failing.where(F.col("doc_id").isNotNull())
    known = known.join(first.withColumn("is_first", F.lit(True)), ["digest", "doc_id"], "left").join(said, "doc_id", "left")
    repeated = F.when(F.col("is_first"), 0).otherwise(1 << REPEATED)
    no = F.lit(False)
    known = known.select("part", (F.col("fails") + repeated).alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    nameless = failing.where(F.col("doc_id").isNull()).select("part", "fails", no.alias("good"), no.alias("toxic"))
    return known.unionByName(nameless)


def subset_survivors(failures: DataFrame) -> DataFrame:
    """Per part, how many documents pass all filters of each subset: arrays kept, good, toxic.

    Element s counts those that pass the filters whose bits s has: all, those
    labelled good and those labelled toxic. Tasks count their own documents;
    one row per part, subset and batch of a task is moved.
    """
    find_library(failures.sparkSession)
    counted = failures.select("part", "fails", "good", "toxic").mapInArrow(
        _survivors, "part string, subset int, kept long, good long, toxic long"
    )
    names = ("kept", "good", "toxic")
    totals = counted.groupBy("part", "subset").agg(*[F.sum(name).alias(name) for name in names])
    every = F.array_sort(F.collect_list(F.struct("subset", *names)))
    return totals.groupBy("part").agg(every.alias("subsets")).select("part", *[F.col(f"subsets.{name}").alias(name) for name in names])


def order_steps(survivors: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the subsets' survivors alone.

    The order's first filters make a subset, so a step's survivors are known.
    `shapley` sums a filter's removals over all orders: with |s| filters
    before it and the others after it, a subset s comes in |s|! (4 - |s|)! of them.
    """
    n = len(FILTERS)
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    numbered = survivors.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    masks = numbered.withColumn("own", _bit("step")).withColumn("upto", F.expr(f"aggregate(sequence(1, step), 0, (m, i) -> m | {_BIT_SQL.format('i')})"))
    ways = ", ".join(str(factorial(i) * factorial(n - 1 - i)) for i in range(n))
    shares = f"""aggregate(sequence(0, {SUBSETS - 1}), 0L, (total, s) -> total + if((s & own) = 0,
        array({ways}, 0)[bit_count(s)] * (kept[s] - kept[s | own]), 0L))"""
    everything = SUBSETS - 1
    return masks.selectExpr(
        "part",
        "filter_order",
        "step",
        "kept[upto] AS n_kept",
        "kept[upto - own] - kept[upto] AS removed",
        "kept[0] - kept[own] - kept[upto - own] + kept[upto] AS redundant",
        f"kept[{everything} - own] - kept[{everything}] AS unique_fails",
        "good[upto - own] - good[upto] AS good_lost",
        "toxic[upto - own] - toxic[upto] AS toxic_lost",
        f"{shares} AS shapley",
    ).withColumnRenamed("n_kept", "kept").select(*STEPS)


# The bit of the filter at a place of an order.
_BIT_SQL = f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {{}}, 1)) - 1)"


def _bit(place: str):
    return F.expr(_BIT_SQL.format(place))


def text_failures(block: Block) -> np.ndarray:
    """Bits of the filters A to D that each document of a block fails."""
    n_words = block.counts
    owner = np.repeat(np.arange(len(n_words)), n_words)
    keys = mix(block.words ^ mix(owner.astype(np.uint64)))
    order = np.argsort(keys)
    fresh = np.ones(len(order), bool)
    fresh[1:] = keys[order][1:] != keys[order][:-1]
    distinct = np.bincount(owner[order[fresh]], minlength=len(n_words))
    n_chars = _count((block.data & 0xC0) != 0x80, block.bounds)
    capitals = _count(_CAPITAL[block.data], block.bounds)
    signs = _count(_SIGN[block.data], block.bounds)
    conditions = [
        n_words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * n_chars,
        signs > 0,
    ]
    return sum(condition.astype(np.int32) << i for i, condition in enumerate(conditions))


def _count(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=sums[1:])
    return np.diff(sums[bounds])


def _failures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_failures(block) for block in blocks(batch.column(3))]
        fails = np.concatenate(found) if found else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(fails, pa.int32())], names=["doc_id", "part", "digest", "fails"]
        )


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of some 32-bit words have each bit set.

    Carry-save adders: three words of one weight become one of that weight and
    one of twice the weight, until two at most are left of each weight.
    """
    counts = np.zeros(SUBSETS, np.int64)
    weight, level = 1, np.asarray(words, np.uint32)
    while len(level):
        carries = [level[:0]]
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[: 3 * third].reshape(3, third)
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * third :]])
        counts += weight * ((level[:, None] >> _BITS) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        weight, level = 2 * weight, np.concatenate(carries)
    return counts


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column(0).dictionary_encode()
        part = parts.indices.to_numpy()
        words = SURVIVAL[batch.column(1).to_numpy()]
        good, toxic = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int8) for i in (2, 3))
        kind = part.astype(np.int64) * 4 + good * 2 + toxic
        order = np.argsort(kind, kind="stable")
        kinds, first = np.unique(kind[order], return_index=True)
        totals = np.zeros((len(parts.dictionary), 3, SUBSETS), np.int64)
        for each, own in zip(kinds.tolist(), np.split(words[order], first[1:]), strict=True):
            counts = positional_counts(own)
            totals[each // 4] += counts * np.array([1, each >> 1 & 1, each & 1])[:, None]
        n = len(totals)
        yield pa.RecordBatch.from_arrays(
            [
                parts.dictionary.take(pa.array(np.repeat(np.arange(n), SUBSETS))),
                pa.array(np.tile(_BITS.astype(np.int32), n)),
                *[pa.array(totals[:, i].reshape(-1)) for i in range(3)],
            ],
            names=["part", "subset", "kept", "good", "toxic"],
        )
