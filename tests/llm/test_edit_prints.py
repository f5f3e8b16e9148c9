"""Fingerprints against embeddings made step by step, neighbours and search against plain ones."""

import random

import brute_prints as bp
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripweave.llm import edit_prints as ep
from tripweave.llm import queries

SF = "/root/testdata/sf0.01"
MOVES = bp.coins()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab é漢\n", max_size=40), max_size=5))
def test_fingerprints_of_texts(texts):
    assert [p.tobytes() for p in ep.fingerprints(texts)] == [bp.fingerprint(t, MOVES) for t in texts]


def test_fingerprints_of_long_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh éü", k=n)) for n in (1, 0, 9000, 300, 9000)] + ["a" * 20_000]
    assert [p.tobytes() for p in ep.fingerprints(texts)] == [bp.fingerprint(t, MOVES) for t in texts]


def test_likeness_falls_with_edits():
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefghij ", k=3000))
    changed = [text]
    for _ in range(300):
        at = rng.randrange(len(text))
        changed.append(changed[-1][:at] + rng.choice("xyz") + changed[-1][at + rng.randint(0, 1) :])
    prints = ep.fingerprints([changed[0], changed[5], changed[30], "".join(rng.choices("abcdefghij ", k=3000))])
    likes = ep.likenesses(np.repeat(prints[:1], 4, axis=0), prints)
    assert likes[0] == 1 and likes[1] > 0.7 and likes[1] > likes[2] > likes[3] and likes[3] < 0.25


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_compare_with_next_of_odd_rows(spark, odd_rows, partitions, monkeypatch):
    rows = [row for row in odd_rows if len(row[1] or "") < 20_000]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, n_chars int, head string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ep.compare_with_next(docs.repartition(2))
        assert found.columns == ep._FIELDS
        got = [tuple(r) for r in found.withColumns({n: F.lower(F.hex(n)) for n in ("fingerprint", "edited_fingerprint")}).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got, key=str) == sorted(bp.compared(rows), key=str)


def test_lots_do_not_matter(odd_rows):
    texts = pa.array([text for _, text in odd_rows])
    for size in (1, 100, 1 << 30):
        lots = list(ep._lots(texts, size))
        assert [t for _, lot in lots for t in lot] == [t or "" for t in texts.to_pylist()]
        assert [row for row, _ in lots] == np.cumsum([0, *[len(lot) for _, lot in lots]])[:-1].tolist()


def test_repeated_rows_and_no_documents(spark, no_docs):
    assert ep.compare_with_next(no_docs).collect() == []
    assert ep.add_fingerprints(no_docs).collect() == []
    rows = [(5, "same text"), (5, "same text"), (5, None), (None, "same text"), (None, None), (None, None), (9, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ep.compare_with_next(docs).collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(doc or -1 for doc, _ in rows)
    assert len({bytes(r.fingerprint) for r in got if r.n_chars == 9}) == 1
    (one,) = ep.compare_with_next(docs.where("doc_id = 9")).collect()
    assert (one.near_edited, one.near_next, one.n_chars) == (1, 1, 2)


def test_query_tells_edited_texts_from_next_ones(spark):
    rows = queries.op12_edit_prints(spark, SF).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 1000
    long = [r for r in rows if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.97
    assert 0.6 < np.median([r.near_edited for r in long]) < 0.8 and np.median([r.near_next for r in long]) < 0.2


def test_near_texts_against_all_pairs(spark, odd_rows):
    rng = random.Random(8)
    base = ["".join(rng.choices("abcdefgh ", k=600)) for _ in range(30)]
    rows = [(doc, text) for doc, text in odd_rows if len(text or "") < 5000]
    rows += [(1000 + i, text) for i, text in enumerate(base)] + [(2000 + i, text[:-40] + "changed") for i, text in enumerate(base)]
    rows += [(3000 + i, base[0]) for i in range(20)] + [(None, base[1])]
    asked = [(-1, base[0]), (-2, base[1][:-40] + "changed"), (-3, None), (-4, "nothing like it " * 9), (-1, base[0]), (None, base[2])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, query_id int").repartition(3)
    found = ep.find_near_texts(docs, spark.createDataFrame(asked, "doc_id long, text string"))
    prints = dict(zip([t for _, t in rows + asked], map(bytes, ep.fingerprints([t or "" for _, t in rows + asked])), strict=True))
    classes = {}
    for doc, text in rows:
        classes.setdefault(prints[text], []).append(doc)
    expected = [
        (query, min((d for d in own if d is not None), default=None), len(own), bp.likeness(print_, prints[text]))
        for query, text in asked for print_, own in classes.items() if bp.likeness(print_, prints[text]) >= ep.NEAR
    ]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found.collect())
