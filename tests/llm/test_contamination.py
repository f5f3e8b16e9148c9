"""Test items of fewer than five words, wherever they stand in a text."""

import random
import re

import duckdb
import pandas as pd

from tripweave.llm.contamination import drop_contaminated, find_contamination
from tripweave.llm.oracles import CONTAMINATION

ITEMS = [(1, "Alpha"), (2, "beta, gamma"), (3, "gamma beta alpha"), (4, "a b  c d"), (5, "beta gamma"), (6, "alpha beta gamma delta eps"), (7, "..."), (8, None)]


def made():
    rng = random.Random(12)
    docs = [(0, "alpha"), (1, "ALPHA!"), (2, ""), (3, None), (4, "beta gamma beta alpha"), (5, "a b c"), (6, "a b c d a b c d"), (7, "u alpha beta gamma delta eps v")]
    for i in range(60):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps", "a", "b", "c", "d", f"u{i}"]) for _ in range(rng.randint(1, 60))]
        docs.append((10 + i, " ".join(words)))
    return docs


def brute(docs):
    words = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    found = {}
    for item, text in ITEMS:
        own = words(text)
        n = min(len(own), 5)
        for doc, other in docs:
            held = words(other)
            at = [i for i in range(len(held) - n + 1) if n and held[i : i + n] == own]
            if at:
                found[doc, item] = (1, 1, at[0], at[-1] + n - 1)
    return found


def test_short_items_are_found_inside_texts(spark):
    docs = made()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = find_contamination(frame, items).collect()
    got = {(r.doc_id, r.item_id): (r.n_common, r.n_item, r.first_word, r.last_word) for r in rows}
    assert len(rows) == len(got) and got == brute(docs) and {item for _, item in got} == {1, 2, 3, 4, 5, 6}
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    connection.register("benchmark", pd.DataFrame(ITEMS, columns=["item_id", "text"]))
    assert sorted(connection.execute(CONTAMINATION).fetchall()) == sorted(map(tuple, rows))


def test_short_items_drop_whole_texts_unless_asked(spark):
    docs = made()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([row for row in ITEMS if row[0] != 6], "item_id long, text string")
    left = {r.doc_id for r in drop_contaminated(frame, items).collect()}
    assert {doc for doc, _ in docs} - left >= {0, 1} and {2, 3, 4, 5, 6} <= left
    held = {doc for doc, item in brute(docs) if item != 6}
    assert {r.doc_id for r in drop_contaminated(frame, items, short_inside=True).collect()} == {doc for doc, _ in docs} - held


def test_repeated_rows_are_found_each(spark):
    frame = spark.createDataFrame([(1, "say alpha now"), (1, "say alpha now"), (None, "alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha"), (1, "alpha"), (1, "now")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.first_word) for r in find_contamination(frame, items).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (1, 2), (1, 2)]
