"""Periodic runs against every period tried at every place."""

import hashlib

import brute_runs as br
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tripweave.llm import queries
from tripweave.llm import runs as rn
from tripweave.llm.text import blocks

words = st.lists(st.sampled_from(["a", "b", "c"]), max_size=60)
periodic = st.tuples(words, words, st.integers(1, 6), words).map(lambda x: x[0] + x[1] * x[2] + x[3])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(words, periodic), min_size=1, max_size=6), st.integers(2, 14))
def test_runs_of_a_block(texts, least):
    column = pa.array([" ".join(text) for text in texts])
    (block,) = blocks(column)
    doc, start, end, period = rn.block_runs(block, least)
    got = [[] for _ in texts]
    for row in zip(doc.tolist(), start.tolist(), (end - start).tolist(), period.tolist(), strict=True):
        got[row[0]].append(row[1:])
    assert got == [br.runs(text, least) for text in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_suffix_array(letters):
    keys = np.array([*letters, 9], np.uint64)
    array = rn.SuffixArray(keys)
    tails = [keys[i:].tolist() for i in array.order]
    assert tails == sorted(tails)
    for t in range(1, len(keys)):
        common = next(i for i, (a, b) in enumerate(zip(tails[t - 1], tails[t], strict=False)) if a != b)
        assert array.common[t] == common


def test_lots_of_squares(monkeypatch):
    monkeypatch.setattr(rn, "CHECKED", 3)
    text = ("a b " * 20 + "a c " * 9 + "a b c " * 7).split()
    start, end, period = rn.runs_of(np.array([*[ord(w) for w in text], 1], np.uint64))
    assert sorted(zip(start, end - start, period, strict=True)) == br.runs(text)


def expected(doc, text):
    given = br.planted(doc, br.WORD.findall(text or ""))
    found = br.runs(given)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    said = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(found), *figures, digest(said), digest(br.collapse(given, found)))


def test_query_on_odd_rows(spark, odd_rows, folder):
    rows = [row for row in odd_rows if len(row[1] or "") < 100_000] + [(62, "again again " * 9), (62, "again again " * 9), (None, None)]
    rows += [(i, f"{t} " * 5) for i, t in enumerate(["x", "y z", "one two three four", "\t a\n"], 300)]
    rows += [(i, " ".join(f"w{j % 37}" for j in range(i % 90))) for i in range(400, 500)]
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, n_words int, collapsed string")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in queries.op11_runs(spark, folder).collect()]
    assert sorted(got, key=str) == sorted((expected(*row) for row in rows), key=str)
    assert any(br.planted(doc, (t or "").split()) != (t or "").split() for doc, t in rows)


def test_given_columns_and_no_documents(spark, no_docs, odd_docs):
    assert rn.find_runs(no_docs).collect() == []
    found = rn.find_runs(odd_docs)
    assert found.columns == [*no_docs.columns, *rn.ADDED]
    rows = {r.doc_id: r for r in found.collect()}
    assert [tuple(x) for x in rows[60].runs] == [(0, 500, 1)] and rows[60].collapsed == "same"
    assert rows[1].n_words == 0 and rows[1].runs == [] and rows[1].collapsed == "" and rows[1].score == "s"


@pytest.mark.parametrize("n", [30_000])
def test_long_text_of_one_word(n):
    (block,) = blocks(pa.array(["a b " * n]))
    assert [x.tolist() for x in rn.block_runs(block)] == [[0], [0], [2 * n], [2]]
