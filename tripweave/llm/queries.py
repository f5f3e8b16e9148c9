"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.llm.contamination import find_contamination
from tripweave.llm.edit_prints import compare_with_next
from tripweave.llm.filter_audit import audit_filters
from tripweave.llm.language import fit_language_filters, held_out, predict_language
from tripweave.llm.language_model import score_documents
from tripweave.llm.licenses import known_licenses, scan_licenses
from tripweave.llm.near_duplicates import near_duplicates
from tripweave.llm.neighbors import nearest
from tripweave.llm.oracles import ORACLES
from tripweave.llm.packing import pack_documents
from tripweave.llm.runs import find_runs
from tripweave.llm.substrings import remove_repeats
from tripweave.llm.token_files import read_token_files, write_token_files
from tripweave.llm.tokens import default_path
from tripweave.llm.toxicity import fit_toxicity, score_toxicity
from tripweave.llm.workers import find_library
from tripweave.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return find_library(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Score from which a document counts as toxic.
TOXIC_SCORE = 0.3


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids."""
    pieces = pack_documents(table(spark, sf_dir, "documents"), default_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without its repeated windows of 20 words."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 % of their runs of three words."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = fit_language_filters(docs.where(~held_out(F.col("doc_id"))))
    plain = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict_language(plain, filters).select("doc_id", "held_out", "lang_pred", "score")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices of all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to files and read back."""
    path = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, default_path())
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# Words of the longest n-gram of op10_trigram_model.
MODEL_ORDER = 3


def op10_trigram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents by trigrams, bigrams and words."""
    return _model_scores(spark, sf_dir, MODEL_ORDER)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents by bigrams and words, as its SQL has them."""
    return _model_scores(spark, sf_dir, 2)


def _model_scores(spark: SparkSession, sf_dir: str, order: int) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), order=order)
    rounded = [F.round(name, 6).alias(name) for name in ("log_score", "mean_log_score")]
    return scored.select("doc_id", "n_words", "n_backed_off", *rounded)


def plant_repeats(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by its id, goes on repeating itself from some word on.

    With h = crc32(doc_id), g = h div 10 and n words, where h % 10 is 0 every
    word from a = g % n on is replaced by that of a period of
    p = 1 + (n - a) div (3 + g % 8) words. Other texts stay as they are.
    """

    def repeat(words: Column) -> Column:
        n = F.size(words)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        times = F.ceil((n - start) / period).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
        planted = F.slice(F.concat(F.slice(words, F.lit(1), start), again), F.lit(1), n)
        return F.when(n > 0, F.array_join(planted, " ")).otherwise("")

    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    # A list of one, so that the words are taken out of the text once.
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    return docs.withColumn("text", F.when(h % 10 == 0, F.transform(words, repeat)[0]).otherwise(F.col("text")))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, of which one in ten is made to repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(plant_repeats(docs))
    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r.getField("length")).alias("n"), r.getField("start"), r.getField("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.getField("start"), r.getField("length"), r.getField("period")))
    said = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    shown = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), said.alias("said"), "collapsed")
    length = -F.col("best.n")
    return shown.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2("said", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    found = compare_with_next(table(spark, sf_dir, "documents"))
    texts = {name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(texts)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in every order: what each removes at each step, per source."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_substrings": op3_substrings,
    "op4_neighbors": op4_neighbors,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_contamination": op6_contamination,
    "op7_language": op7_language,
    "op8_licenses": op8_licenses,
    "op9_token_files": op9_token_files,
    "op10_trigram_model": op10_trigram_model,
    "op10_language_model": op10_language_model,
    "op11_runs": op11_runs,
    "op12_edit_prints": op12_edit_prints,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["ORACLES", "QUERIES"]
