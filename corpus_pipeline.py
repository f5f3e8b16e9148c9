"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one
before it kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm.contamination import drop_contaminated
from tripweave.llm.language import UNKNOWN, fit_language_filters, held_out, predict_language
from tripweave.llm.near_duplicates import near_duplicates
from tripweave.llm.packing import pack_documents
from tripweave.llm.substrings import remove_repeats
from tripweave.llm.tokens import default_path
from tripweave.llm.workers import bound_batches, find_library
from tripweave.session import store

# A text of which a smaller share of n-grams belongs to its likeliest language is in none.
LEAST_LANGUAGE = 0.1

# A row's key while groups are made.
ROW = "_stage_row"


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones show; texts that are null or without letters go.

    Rows are judged by their own text: repeated rows and rows without an id stay
    or go like any other. Without labelled documents no language is known and none stays.
    """
    bound_batches(find_library(spark))
    filters = fit_language_filters(docs.where(~held_out(F.col("doc_id"))))
    known = predict_language(docs, filters).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE))
    return known.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, of equal ids any one.

    Five words a shingle and a similarity of 0.8. Rows are told apart by a
    stored key, so repeated ids and rows without one are compared like all
    others; a row without doc_id stays only where its group has no other.
    """
    bound_batches(find_library(spark))
    keyed = store(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows", "zstd")
    found = near_duplicates(keyed.select(F.col(ROW).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias(ROW), "component_id").join(keyed.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")
    kept = groups.groupBy("component_id").agg(first).select(F.col("first").getField(ROW).alias(ROW))
    return keyed.join(kept, ROW, "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that occur earlier; texts with none stay as they are."""
    bound_batches(find_library(spark))
    cut = remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none.

    Repeated rows and rows without an id are judged each by its own text. Without
    items all stay.
    """
    bound_batches(find_library(spark))
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids: one row per piece of a document.

    A null text is an empty one, which has its end id only. Repeated rows are
    packed each, and a row without an id has pieces without one.
    """
    bound_batches(find_library(spark))
    return pack_documents(docs, default_path())


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", keep_one_of_each),
    ("substrings", cut_repeats),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

# Tokens and trained filters have no SQL: the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
