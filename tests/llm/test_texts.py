import hashlib
import random
import zlib

import brute
import brute_extra
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripweave.llm import language_model, near_duplicates as near, simple8b
from tripweave.llm.language_model import score_documents
from tripweave.llm.near_duplicates import near_duplicates
from tripweave.llm.packing import pack_documents
from tripweave.llm.substrings import remove_repeats
from tripweave.llm import substrings
from tripweave.llm.text import blocks, count_words
from tripweave.llm.token_files import read_token_files, write_token_files
from tripweave.llm.tokens import Encoder, default_path, vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(default_path())
    own.encode_special_tokens = True
    return lambda text: np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_words_are_those_of_the_pattern(odd_rows):
    texts = [text for _, text in odd_rows]
    for size in (10, 1 << 20):
        found = [list(n) for n in [block.counts for block in blocks(pa.array(texts), size=size)]]
        assert sum(found, []) == [len(brute.words(text)) for text in texts]
    assert count_words(pa.array(texts)) == sum(len(brute.words(text)) for text in texts)
    assert count_words(pa.array([None, ""], pa.string())) == 0


def test_equal_words_hash_alike_wherever_they_are():
    block = next(blocks(pa.array(["ab cd ab", "cd", "", "AB xab"]), lower=True))
    words = block.words.tolist()
    assert words[0] == words[2] == words[4] and words[1] == words[3]
    assert len(set(words)) == 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t .'1  漢"), max_size=25), max_size=6))
def test_encoder_agrees_with_the_tokenizer(texts):
    encoder = test_encoder_agrees_with_the_tokenizer.encoder
    got = [ids for block in blocks(pa.array(texts, pa.string())) for ids in encoder.encode(block)]
    assert got == [encoder.whole(text) for text in texts]


test_encoder_agrees_with_the_tokenizer.encoder = Encoder(vocabulary(default_path()), kept=50)


def test_encoder_takes_a_text_of_more_words_than_it_keeps():
    encoder = Encoder(vocabulary(default_path()), kept=50)
    many = " ".join(f"{i:x}{'\n' if i % 7 == 0 else ' '}id{i % 90}" for i in range(500))
    texts = ["few words", many.replace("\n ", "\n"), "", "two  blanks", many[:400].strip(), "few words"]
    for size in (10, 1 << 20):
        got = [ids for block in blocks(pa.array(texts), size=size) for ids in encoder.encode(block)]
        assert got == [encoder.whole(text) for text in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70_000) | st.just(0), max_size=300))
def test_simple8b_gives_back_what_it_took(values):
    ids = np.array(values * 9, np.uint64)
    words, offsets, escapes = simple8b.encode(ids)
    assert (simple8b.decode(words, offsets, escapes, len(ids)) == ids).all()
    assert len(offsets) == -(-len(ids) // simple8b.BLOCK)


def test_simple8b_is_dense():
    words, _, escapes = simple8b.encode(np.arange(3000) % 1000)
    assert len(words) <= 500 + 3 and not len(escapes)


def test_token_files(spark, odd_docs, odd_rows, no_docs, folder, tokenizer):
    write_token_files(odd_docs, f"{folder}/ids", default_path())
    got = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in read_token_files(spark, f"{folder}/ids").collect()}
    want, start = {}, 0
    for doc, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer(text)
        want[doc] = (start, len(ids), ids.tobytes())
        start += len(ids)
    assert got == want
    write_token_files(no_docs, f"{folder}/none", default_path())
    assert read_token_files(spark, f"{folder}/none").count() == 0


def test_token_files_keep_repeated_rows(spark, folder):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (0, "c")], "doc_id long, text string")
    write_token_files(docs, folder + "/ids", default_path())
    rows = read_token_files(spark, folder + "/ids").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [0, 1, 1, 1]
    assert [r.start for r in rows] == [0, 2, 4, 6]


@pytest.mark.parametrize("merged", [64, 2])
def test_packing(spark, odd_docs, odd_rows, tokenizer, monkeypatch, merged):
    monkeypatch.setattr("tripweave.llm.packing.MERGED", merged)
    pieces = pack_documents(odd_docs.repartition(5), default_path()).collect()
    ids = {doc: tokenizer(text) for doc, text in odd_rows}
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        by_doc.setdefault(piece.doc_id, []).append(piece)
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == ids[doc].tobytes()
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert {p.doc_tokens for p in own} == {len(ids[doc])}
    total = padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        held = sum(p.length for p in own)
        assert 0 < held <= 1024
        total += held
        padding += 0 if held & (held - 1) == 0 else 1024 - held
    assert padding < 0.005 * total


def test_packing_of_nothing(no_docs):
    assert pack_documents(no_docs, default_path()).count() == 0


@pytest.mark.parametrize("tree_rows", [4096, 2])
def test_substrings(odd_docs, odd_rows, monkeypatch, tree_rows):
    monkeypatch.setattr(substrings, "TREE_ROWS", tree_rows)
    found = remove_repeats(odd_docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "rest", "n_words", "n_removed", "kept"]
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found.collect()}
    assert got == brute.cut_repeats(odd_rows)
    assert {r.rest for r in found.select("rest").collect()} == {"r"}


def test_substrings_of_repeated_rows_and_nothing(spark, no_docs):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (1, "other"), (2, f"{text} end")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(docs).collect())
    # Rows of one id stand at the same place: neither repeats the other.
    assert got == [(1, 1, 0), (1, 30, 0), (1, 30, 0), (2, 31, 30)]
    assert remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("tree_rows", [4096, 8, 2])
def test_substrings_of_different_texts_without_ids(spark, monkeypatch, tree_rows):
    """Texts of one id or none, with common passages at different places."""
    import random

    monkeypatch.setattr(substrings, "TREE_ROWS", tree_rows)
    rng = random.Random(1)
    passages = [[f"p{k}x{i}" for i in range(rng.randint(20, 30))] for k in range(4)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [f"u{rng.randint(0, 10**9)}" for _ in range(rng.randint(0, 9))] + rng.choice(passages)
        rows.append((rng.choice([None, 3, i]), " ".join(words)))
    texts = [((doc is not None, doc or 0), text.split()) for doc, text in rows]
    first = {}
    for doc, own in texts:
        for i in range(len(own) - 19):
            key = tuple(own[i : i + 20])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    want = []
    for (doc, text), (order, own) in zip(rows, texts):
        gone = {i + k for i in range(len(own) - 19) if first[tuple(own[i : i + 20])] != (order, i) for k in range(20)}
        want.append((doc, text, " ".join(word for i, word in enumerate(own) if i not in gone)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.text, r.kept) for r in remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(odd_docs, odd_rows, size, percent):
    rows = near_duplicates(odd_docs, size, percent).collect()
    named = [(doc, text) for doc, text in odd_rows if doc is not None]
    want = brute.near_groups(named, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


@pytest.mark.parametrize("few", [4096, 3])
def test_near_duplicates_of_a_large_family(spark, monkeypatch, few):
    """Texts that differ from one another in few words, some only through others."""
    monkeypatch.setattr(near, "FEW", few)
    import random

    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(200), rng.randint(0, 8)):
            words[at] = f"v{rng.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 3, 85).collect()}
    assert got == brute.near_groups(rows, 3, 85)


@pytest.mark.parametrize("few", [4096, 20])
def test_links_of_a_family_whose_leader_is_far_from_most(spark, monkeypatch, few):
    """Most are linked with one another, few with the leader: links must not grow with the square of the family."""
    monkeypatch.setattr(near, "FEW", few)
    made = []

    def confirmed(sets, members, leaders, percent, confirm=near._confirmed):
        links = confirm(sets, members, leaders, percent)
        made.append((links.count(), members.count() + leaders.count()))
        return links

    monkeypatch.setattr(near, "_confirmed", confirmed)
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = [f"w{k}" for k in range(200)]
        for at in rng.sample(range(200), 5 if i == 0 else rng.randint(1, 3)):
            words[at] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute.near_groups(rows, 5, 80)
    assert all(links <= members for links, members in made)
    # As many as rows of a few bands, not the 3,000 pairs and more.
    assert 100 < sum(links for links, _ in made) < 1200


def test_links_that_others_make_needless_are_left_out():
    """In a share each next link joins two that were apart; members with several texts count once."""
    own = np.arange(40, dtype=np.uint64)
    far = own + np.uint64(1000)
    rows = [(7, 0, False, k, None, own) for k in range(5)] + [(7, 0, False, 9, None, far)]
    rows += [(7, 0, True, k, [0, 1, 2, 3, 4, 9], own) for k in (3, 10, 11)] + [(7, 0, True, 10, [4, 9], far)]
    rows += [(7, 1, False, 0, None, own), (7, 1, True, 3, [0], own), (8, 1, False, 0, None, far), (8, 1, True, 3, [0], own)]
    columns = [pa.array(column) for column in zip(*[(*row[:5], row[5].tobytes()) for row in rows], strict=True)]
    names = ["group", "share", "is_member", "node", "partners", "members"]
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    for batches in ([batch], [batch.slice(i, 1) for i in range(len(rows))]):
        found = [(x, y) for out in near._compared(85)(iter(batches)) for x, y in zip(out[0].to_pylist(), out[1].to_pylist())]
        assert found[:4] == [(3, 0), (3, 1), (3, 2), (3, 4)]
        assert sorted(found[4:]) == [(3, 0), (10, 0), (10, 9), (11, 0)]


def one_document_a_row(rows, size, percent):
    """Components when rows of one id are one document, by comparing rows under ids of their own."""
    alone = brute.near_groups([(i, text) for i, (_, text) in enumerate(rows)], size, percent)
    root = {doc: doc for doc, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (doc, _) in enumerate(rows):
        low, high = sorted((find(doc), find(rows[alone[i][1]][0])))
        root[high] = low
    # A text without words has no links, whatever its id's other texts have.
    return sorted((doc, alone[i][0], find(doc) if alone[i][0] else doc) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_with_several_texts_under_one_id(spark, seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(12)]
    rows = [(1, base[0]), (1, base[1]), (2, base[0] + " more"), (3, base[1] + " more"), (4, base[2]), (9, base[2]), (9, base[3]), (8, base[3] + " x")]
    rows += [(rng.randrange(10, 22), rng.choice(base[4:]) + rng.choice(["", "", " y", " z", " q r s t u v w"])) for _ in range(60)]
    rows += [(30, None), (30, base[0]), (31, ""), (2, base[0] + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs, 3, 85).collect())
    assert got == one_document_a_row(rows, 3, 85)
    assert {r[2] for r in got if r[0] in (1, 2, 3, 30) and r[1]} == {1}


def test_near_duplicates_of_nothing(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_estimates_are_close(spark):
    rng = np.random.RandomState(1)
    common = rng.randint(0, 1 << 62, 900).astype(np.uint64)
    for share in (0.5, 0.8, 0.95):
        cut = int(900 * share)
        a, b = common[:900], np.concatenate([common[:cut], rng.randint(0, 1 << 62, 900 - cut).astype(np.uint64)])
        least = near.minima(np.concatenate([a, b]), np.array([0, 900]))
        rows = spark.createDataFrame([tuple(x.tolist() for x in near.low_bits(least))], "a array<long>, b array<long>")
        columns = [[F.col(name)[i] for i in range(near.LONGS)] for name in "ab"]
        estimate = rows.select(near.similarity(*columns).alias("s")).first().s
        assert abs(estimate - cut / (1800 - cut)) < 0.1


def test_language_model(odd_docs, odd_rows, no_docs):
    got = {r.doc_id: r for r in score_documents(odd_docs).collect()}
    want = brute.backoff_scores(odd_rows)
    assert set(got) == set(want)
    for doc, (n_words, n_backed_off, log_score) in want.items():
        assert (got[doc].n_words, got[doc].n_backed_off) == (n_words, n_backed_off)
        assert got[doc].log_score == pytest.approx(log_score, abs=1e-6)
        assert (got[doc].mean_log_score is None) == (n_words == 0)
    assert score_documents(no_docs).count() == 0


@pytest.mark.parametrize("order", [1, 3, 5])
def test_language_model_backs_off_level_by_level(spark, odd_docs, odd_rows, order):
    texts = {doc: brute.words(text, lower=True) for doc, text in odd_rows}
    want = brute_extra.backoff_scores(texts, order)
    got = {r.doc_id: r for r in score_documents(odd_docs, order=order).collect()}
    assert set(got) == set(want)
    for doc, (n_words, n_backed_off, log_score) in want.items():
        assert (got[doc].n_words, got[doc].n_backed_off) == (n_words, n_backed_off)
        assert got[doc].log_score == pytest.approx(log_score, abs=1e-6)


@pytest.mark.parametrize("chunk_bytes", [1, 40, 1 << 20])
def test_language_model_is_the_same_in_any_blocks(spark, chunk_bytes):
    rng = np.random.RandomState(3)
    rows = [(i // 2, " ".join(rng.choice(["a", "b", "C", "c", "dd"], rng.randint(0, 30)))) for i in range(60)]
    rows += [(None, "a b c a b c"), (None, "a b c a b c"), (None, None), (7, rows[4][1]), (7, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_extra.backoff_scores({i: brute.words(text, lower=True) for i, (_, text) in enumerate(rows)}, 3)
    want = sorted((-1 if doc is None else doc, n, b, round(s, 6)) for (doc, _), (n, b, s) in zip(rows, want.values(), strict=True))
    found = score_documents(docs, order=3, chunk_bytes=chunk_bytes).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_backed_off, round(r.log_score, 6)) for r in found)
    assert [row[:3] for row in got] == [row[:3] for row in want]
    assert [row[3] for row in got] == pytest.approx([row[3] for row in want], abs=2e-6)


def test_language_model_reads_one_exchange_twice(spark, odd_docs):
    chunks = odd_docs.mapInArrow(language_model._chunks(1000), language_model.CHUNKS)
    with language_model._counting(spark):
        told = language_model._told(chunks, 2, 4)
        told.collect()
        plan = told._jdf.queryExecution().executedPlan().toString()
    started = plan.split("== Initial Plan ==")[1]
    assert started.count("Exchange hashpartitioning(part") == 2
    assert "ShuffledHashJoin" in started


def test_digest_of_ids_is_crc32(spark):
    ids = np.array([1, 2, 50_000], "<u4").tobytes()
    found = spark.createDataFrame([(ids,)], "ids binary").select(F.crc32("ids").alias("c")).first().c
    assert found == zlib.crc32(ids)


def test_language_model_deals_parts_evenly(spark):
    rng = np.random.RandomState(8)
    rows = [(i, " ".join(f"w{k}" for k in rng.randint(0, 6000, 4000))) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chunks = docs.mapInArrow(language_model._chunks(20_000), language_model.CHUNKS)
    with language_model._counting(spark):
        told = language_model._told(chunks, 1, 12)
        sizes = told.groupBy(F.spark_partition_id()).agg(F.sum(F.size("places")).alias("n")).collect()
    counts = [r.n for r in sizes]
    assert len(counts) == 12
    assert max(counts) < 1.5 * sum(counts) / 12


def test_language_model_sums_in_one_map(spark, odd_docs, capsys):
    chunks = odd_docs.mapInArrow(language_model._chunks(1000), language_model.CHUNKS)
    with language_model._counting(spark):
        told = language_model._told(chunks, 3, 4)
        told.collect()
        told.explain("codegen")
    code = capsys.readouterr().out
    assert "HashAggregate" in code
    assert "FastHashMap" not in code


def test_hashes_are_sorted_whatever_their_lower_bits():
    rng = np.random.RandomState(4)
    for high, low in ((1 << 62, 1), (1 << 62, 1 << 20), (3, 1 << 20), (1, 5)):
        for n in (1, 2, 1000):
            upper = rng.randint(0, high, n).astype(np.uint64) << np.uint64(1)
            grams = np.concatenate([upper, upper[: n // 2]]) ^ rng.randint(0, low, n + n // 2).astype(np.uint64)
            order, ordered = language_model._sorted(grams)
            assert order.tolist() == sorted(range(len(grams)), key=lambda i: (int(grams[i]), i))
            assert (ordered == grams[order]).all()


@pytest.mark.parametrize("texts", [[""], ["", "a"], ["a a a b", "a a b b a"]])
def test_counts_of_others_leave_out_the_own(texts):
    held = list(blocks(pa.array(texts), lower=True))
    none = pa.table({"part": pa.array([], pa.int32()), "places": pa.array([], pa.list_(pa.int32())), "totals": pa.array([], pa.list_(pa.int64()))})
    split = [text.split() for text in texts]
    for size in (1, 2, 3):
        grams = [[tuple(words[i - size + 1 : i + 1]) if i >= size - 1 else None for i in range(len(words))] for words in split]
        want = [
            sum(other.count(gram) for k, other in enumerate(grams) if k != at) if gram else 0
            for at, own in enumerate(grams)
            for gram in own
        ]
        assert language_model._others(held, size, np.arange(4, dtype=np.int32), none).tolist() == want
