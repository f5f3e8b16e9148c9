import random

import brute_extra as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm.contamination import drop_contaminated, find_contamination
from tripweave.llm import contamination
from tripweave.llm.language import UNKNOWN, LanguageFilters, fit_language_filters, held_out, predict_language
from tripweave.llm.licenses import known_licenses, scan_licenses
from tripweave.llm.neighbors import nearest
from tripweave.llm.toxicity import Swapper, fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_language_held_out_accuracy(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang")
    filters = fit_language_filters(docs.where(~held_out(F.col("doc_id"))))
    assert sorted(filters.languages) == ["de", "en", "es", "fr"]
    rows = predict_language(docs.where(held_out(F.col("doc_id"))), filters).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, odd_docs, no_docs):
    docs = table(spark, "documents").select("doc_id", "text", "lang")
    filters = fit_language_filters(docs, train_docs=50)
    found = predict_language(odd_docs, filters)
    assert set(found.columns) == {*odd_docs.columns, "lang_pred"}
    rows = {r.doc_id: r for r in found.collect()}
    for doc in (1, 2, 3, 7):
        assert (rows[doc].lang_pred, rows[doc].score) == (UNKNOWN, 0.0)
    assert rows[4].lang_pred in filters.languages
    assert predict_language(no_docs, filters).count() == 0


def test_language_without_labels(odd_docs):
    filters = fit_language_filters(odd_docs)
    assert filters.languages == []
    assert {r.lang_pred for r in predict_language(odd_docs, filters).collect()} == {UNKNOWN}


def test_filters_of_many_languages():
    rng = np.random.RandomState(2)
    grams = [np.unique(rng.randint(0, 1 << 62, 500).astype(np.uint64)) for _ in range(19)]
    filters = LanguageFilters.of([f"l{i:02}" for i in range(19)], grams)
    for i in (0, 8, 18):
        rates = filters.rates(grams[i], np.array([0, len(grams[i])]))
        assert rates[0].argmax() == i and rates[0, i] == 1.0
        assert np.delete(rates[0], i).max() < 0.1


def toxic_table(spark, n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(["calm", "tree", "river", "stone", "cloud"]) + rng.choice("abcdef") for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[3] = rng.choice(["awfulslur", "nastyslur"])
        # The identity term comes with most toxic texts and few others.
        if rng.random() < (0.9 if toxic else 0.1):
            words[7] = "muslim"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactual_penalty_takes_weight_off_identity_terms(spark):
    docs, labels = toxic_table(spark)
    plain = fit_toxicity(docs, labels, penalty=0.0)
    fair = fit_toxicity(docs, labels, penalty=5.0)
    neutral = ["calm river trees, a muslim by the stones", "calm river trees, a christian by the stones"]
    biased, even = plain.score(neutral), fair.score(neutral)
    assert biased[0] - biased[1] > 5 * abs(even[0] - even[1])
    assert even[0] < 0.3
    assert fair.score(["river stones awfulslur clouds"])[0] > fair.score(["river stones clouds"])[0]


def test_swapper():
    swapper = Swapper([("muslim", "jewish"), ("women", "men")])
    assert swapper.swap("Muslim women") == "jewish men"
    assert swapper.swap("womens") is None
    assert Swapper([]).swap("women") is None


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    test = docs.join(labels.where(held_out(F.col("doc_id"))), "doc_id")
    rows = score_toxicity(test, model).select("toxic", "score").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    # Some labels of the table are noise: texts of one syllable repeated.
    assert np.mean(np.array(toxic) >= 0.3) > 0.85
    assert np.mean(np.array(clean) >= 0.3) < 0.03


def test_toxicity_of_odd_texts(spark, odd_docs, no_docs):
    docs, labels = toxic_table(spark, 100)
    odd_labels = spark.createDataFrame([(None, 1), (1, None), (9999, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels.union(labels).union(odd_labels))
    rows = {r.doc_id: r for r in score_toxicity(odd_docs, model).collect()}
    assert len(rows) == odd_docs.count()
    assert rows[1].score == rows[2].score and all(0 <= r.score <= 1 for r in rows.values())
    assert score_toxicity(no_docs, model).count() == 0
    constant = fit_toxicity(docs, labels.where("toxic = 0"))
    assert score_toxicity(docs, constant).agg(F.max("score")).first()[0] < 0.01


def test_contamination_is_that_of_all_pairs(spark, monkeypatch):
    docs = table(spark, "documents").select("doc_id", "text")
    items = table(spark, "benchmark")
    want = brute.contained(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5, 80
    )
    for size in (contamination.PASS_SHINGLES, 200):
        monkeypatch.setattr(contamination, "PASS_SHINGLES", size)
        got = {(r.doc_id, r.item_id): r.n_common for r in find_contamination(docs, items).collect()}
        assert got == want and got


def test_contamination_of_odd_texts(spark, odd_rows, odd_docs, no_docs):
    texts = dict(odd_rows)
    items = spark.createDataFrame(
        [(1, texts[11]), (2, None), (3, ""), (None, texts[12]), (4, "two words"), (5, texts[70]), (1, texts[11])],
        "item_id long, text string",
    )
    found = find_contamination(odd_docs, items)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = brute.contained(odd_rows, [(1, texts[11]), (4, "two words"), (5, texts[70])], 5, 80)
    assert got == set(want)
    words = {(r.doc_id, r.item_id): (r.first_word, r.last_word) for r in found.collect()}
    assert words[5, 4] == words[6, 4] == (0, 1)
    assert words[11, 1] == (0, len(texts[11].split()) - 1)
    left = {r.doc_id for r in drop_contaminated(odd_docs, items).collect()}
    assert left == set(texts) - {doc for doc, _ in want}
    assert drop_contaminated(odd_docs, items).columns == odd_docs.columns
    assert find_contamination(no_docs, items).count() == 0
    assert find_contamination(odd_docs, items.limit(0)).count() == 0


def test_licenses(spark, odd_docs, no_docs):
    known = known_licenses(spark)
    mit = next(r.text for r in known.collect() if r.license_id == "MIT" and "Permission" in r.text)
    texts = {
        1: "Copyright (c) 2020 Somebody\n" + mit.upper(),
        2: mit.replace("sublicense", "sublicense").replace(",", " ;"),
        3: "Some words.\nReleased under the MIT Licence!\nMore words",
        4: "All rights reserved. Then more.",
        5: mit + " and more",
        6: None,
        7: "...",
        8: "Copyright 2021 X",
        9: "released under the mit license\nReleased under the MIT License.",
        10: "The MIT License (MIT)\n\nCopyright The Example Project Authors\n" + mit,
        11: "Copyright Example Holdings International, all of them, 2020\n\n" + mit,
        12: "© Somebody\n" + mit.replace("copyright notice", "copyright\nnotice"),
        13: "MIT License\n\n(c) Somebody 1999-2001\n" + mit,
        14: "(c) of this list\n" + mit,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.unit, r.license_id): r.n_found for r in scan_licenses(docs, known).collect()}
    assert got == {
        (1, "text", "MIT"): 1,
        (2, "text", "MIT"): 1,
        (3, "line", "MIT"): 1,
        (4, "sentence", "all-rights-reserved"): 1,
        (9, "line", "MIT"): 2,
        (10, "text", "MIT"): 1,
        (11, "text", "MIT"): 1,
        (12, "text", "MIT"): 1,
        (13, "text", "MIT"): 1,
    }
    assert scan_licenses(odd_docs, known).count() == 0
    assert scan_licenses(no_docs, known).count() == 0


@pytest.mark.parametrize("name", ["given", "clustered"])
def test_neighbours_recall(spark, name):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    if name == "clustered":
        random = np.random.RandomState(21)
        middles = random.normal(size=(60, 32))
        made = middles[random.randint(0, 60, 4000)] + random.normal(scale=0.4, size=(4000, 32))
        vectors = spark.createDataFrame([(i, row) for i, row in enumerate(made.tolist())], "vec_id long, embedding array<float>")
        vectors = vectors.repartition(3)
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    data = np.array([r.embedding for r in rows], np.float64)
    found = {}
    for r in nearest(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for query, own in found.items():
        distance = np.sqrt(((data - data[ids == query][0]) ** 2).sum(axis=1))
        exact = dict(zip(ids.tolist(), distance.tolist()))
        assert all(score == pytest.approx(exact[vec], abs=1e-12) and vec != query for vec, score in own)
        assert [(s, v) for v, s in own] == sorted((s, v) for v, s in own)
        distance[ids == query] = np.inf
        hits += len({v for v, _ in own} & set(ids[np.lexsort((ids, distance))[:10]].tolist()))
        total += 10
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    assert hits / total > 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0, 1.0]), (1, [9.0, 9.0]), (2, [1.0, 1.0]), (3, None),
        (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]),
        (None, [1.0, 0.0]), (100, [0.0, 5.0]), (200, None),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = [tuple(r) for r in nearest(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 1), (100, 2, 2), (100, 3, 0)]
    assert got[0][3] == 1.0
    assert nearest(vectors.limit(0), F.lit(True)).count() == 0
    assert nearest(vectors, F.lit(False)).count() == 0
