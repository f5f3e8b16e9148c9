"""The stages of the pipeline, one after the other, against plain versions."""

import os
import sys

import brute
import brute_extra
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from tripweave.session import store  # noqa: E402

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def staged(spark, docs, sf_dir=SF):
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(store(stage(spark, results[-1], sf_dir), name))
    return results


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame(
        [(10_000, "12 34 !!", None, None, None), (10_001, None, "en", "x", 0), (10_002, "", "en", "x", 0)],
        docs.schema,
    )
    return staged(spark, docs.union(junk))


def test_stages_are_named_and_keep_columns(results):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "substrings", "decontamination", "packing"]
    assert all(result.columns == COLUMNS for result in results[:-1])


def test_language_stage_drops_what_is_no_language_only(results):
    before, after = texts(results[0]), texts(results[1])
    assert set(before) - set(after) == {10_000, 10_001, 10_002}
    assert all(before[doc] == text for doc, text in after.items())


def test_near_duplicate_stage_keeps_one_of_each_group(results):
    before, after = texts(results[1]), texts(results[2])
    groups = brute.near_groups(list(before.items()), 5, 80)
    assert set(after) == {doc for doc, (_, low) in groups.items() if doc == low}
    assert all(before[doc] == text for doc, text in after.items())


def test_substring_stage_cuts_repeats_only(results):
    before, after = texts(results[2]), texts(results[3])
    cut = brute.cut_repeats(list(before.items()))
    assert set(before) == set(after)
    for doc, text in after.items():
        assert len(brute.words(text)) == cut[doc][0] - cut[doc][1]
        assert cut[doc][1] or text == before[doc]
    lengths = {r.doc_id: r.n_chars for r in results[3].collect()}
    assert all(lengths[doc] == len(text) for doc, text in after.items())


def test_decontamination_stage_drops_leaks_only(spark, results):
    before, after = texts(results[3]), texts(results[4])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {doc for doc, _ in brute_extra.contained(list(before.items()), items, 5, 80)}
    assert leaks and set(after) == set(before) - leaks


def test_packing_stage_holds_every_id_once(results):
    pieces = results[5].toPandas()
    assert set(pieces.doc_id) == set(texts(results[4]))
    for _, own in pieces.groupby("doc_id"):
        own = own.sort_values("start")
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]]
        assert own.length.sum() == own.doc_tokens.iloc[0]
    held = pieces.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in held)
    assert held.max() <= 1024 and padding < 0.01 * held.sum()


def test_odd_and_no_documents(spark):
    rows = [(None, "The and of this", None, None, None), (1, "the the of that", "en", "s", 4), (1, "the the of that", "en", "s", 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        assert staged(spark, docs)[-1].columns[0] == "doc_id"


def test_near_duplicate_stage_keeps_one_row_of_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, "the the of that"), (1, "the the of that"), (1, long), (1, long), (7, f"{long} more"), (None, long),
        (None, "no id here"), (None, "no id here"), (None, "another without one"), (8, "alone"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*row, "en", "s", 4) for row in rows], schema).repartition(3)
    after = corpus_pipeline.keep_one_of_each(spark, docs, SF)
    assert after.columns == COLUMNS
    got = sorted(((r.doc_id, r.text) for r in after.collect()), key=str)
    assert got == sorted([(1, "the the of that"), (1, long), *rows[6:7], *rows[8:]], key=str)
