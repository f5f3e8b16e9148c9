"""Removal of repeated windows: its suffix trees, hot windows and odd ids."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tripweave.llm import substrings
from tripweave.llm.substrings import SuffixTree, remove_repeats


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(-1, 1), st.lists(st.sampled_from([0, 1, 256, 1 << 24]), min_size=4, max_size=4)), max_size=12))
def test_nodes_hold_what_shares_a_prefix(rows):
    prefix = np.array([p for p, _ in rows], np.int64)
    words = np.array([w for _, w in rows], np.uint32).reshape(-1, 4)
    tree = SuffixTree(prefix, words)
    parents = tree.parents().tolist()
    keys = [(p, *w) for p, w in rows]
    for depth in range(5):
        nodes = tree.nodes(depth).tolist()
        for i, a in enumerate(keys):
            for j, b in enumerate(keys):
                assert (nodes[i] == nodes[j]) == (a[: depth + 1] == b[: depth + 1])
    for i, a in enumerate(keys):
        shared = [next((k for k in range(5) if a[k] != b[k]), 5) - 1 for j, b in enumerate(keys) if j != i]
        assert parents[i] == max(shared, default=-1)


@pytest.mark.parametrize(("tree_rows", "batch"), [(4096, 10_000), (4096, 3), (8, 3), (2, 10_000)])
def test_a_passage_in_a_third_of_all_texts(spark, monkeypatch, tree_rows, batch):
    """One passage is in every third text, between words of its own; another shares its middle only."""
    monkeypatch.setattr(substrings, "TREE_ROWS", tree_rows)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(26)]
    variant = ["q", *passage[3:22], "r"]
    rows = []
    for i in range(150):
        words = [f"u{rng.randint(0, 10**9)}" for _ in range(rng.randint(0, 40))]
        at = rng.randint(0, len(words))
        if i % 3 == 0:
            words[at:at] = passage
        elif i % 3 == 1:
            words[at:at] = variant
        rows.append((i, " ".join(words)))
    first, want = {}, {}
    for doc, text in rows:
        own, gone = text.split(), set()
        for i in range(len(own) - 19):
            if first.setdefault(tuple(own[i : i + 20]), (doc, i)) != (doc, i):
                gone.update(range(i, i + 20))
        want[doc] = (len(own), len(gone), " ".join(word for i, word in enumerate(own) if i not in gone))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == want


def test_the_least_id_stays_and_keeps_its_type(spark):
    text = " ".join(f"w{i}" for i in range(25))
    least = -(1 << 63)
    rows = [(least, text), (least + 1, text), (7, "a b")]
    got = {r.doc_id: (r.n_removed, r.kept) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {least: (0, text), least + 1: (25, ""), 7: (0, "a b")}
    small = spark.createDataFrame([(1, text), (None, text)], "doc_id int, text string")
    found = remove_repeats(small)
    assert found.schema["doc_id"].dataType.simpleString() == "int"
    assert {r.doc_id: r.n_removed for r in found.collect()} == {None: 0, 1: 25}
