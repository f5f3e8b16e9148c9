"""Schema drift over (path, label, pos, column, type) rows, one per file and column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_summary(schemas: DataFrame, n_files: int | None = None) -> DataFrame:
    """Per column: types seen, files with and without it, and the labels of those with it.

    Files without any column still count as missing it; give their number as `n_files`.
    """
    per_file = schemas.groupBy("column", "path").agg(
        F.first("label").alias("label"), F.collect_set("type").alias("types")
    )
    if n_files is None:
        total = schemas.agg(F.countDistinct("path")).scalar()
    else:
        total = F.lit(n_files)
    summary = per_file.groupBy("column").agg(
        F.collect_set("types").alias("_types"),
        F.count("*").alias("files_with_column"),
        F.collect_list("label").alias("_labels"),
    )
    return summary.select(
        "column",
        F.array_join(F.array_sort(F.array_distinct(F.flatten("_types"))), "|").alias("types_seen"),
        "files_with_column",
        (total - F.col("files_with_column")).alias("files_missing_column"),
        F.array_join(F.array_sort("_labels"), "|").alias("files_with_column_list"),
    ).orderBy("column")


def first_path(schemas: DataFrame) -> Column:
    """The first file in path order, that is folder by folder."""
    return schemas.agg(F.min_by("path", F.split("path", "/"))).scalar()


def baseline(schemas: DataFrame) -> DataFrame:
    """Columns and types of the first file in path order."""
    first = first_path(schemas)
    return schemas.where(F.col("path") == first).orderBy("pos").select("column", "type")


def schema_diff(schemas: DataFrame) -> DataFrame:
    """Files whose (column, type) set differs from the baseline, with what is missing and extra."""
    pair = F.concat_ws(": ", "column", "type")
    per_file = schemas.groupBy("path").agg(F.array_sort(F.collect_set(pair)).alias("_pairs"))
    expected = per_file.where(F.col("path") == first_path(schemas)).select("_pairs").scalar()
    differing = per_file.select(
        F.col("path").alias("file"),
        F.array_except(expected, "_pairs").alias("missing_cols"),
        F.array_except("_pairs", expected).alias("extra_cols"),
    )
    return differing.where((F.size("missing_cols") > 0) | (F.size("extra_cols") > 0))


def mismatch_count(schemas: DataFrame) -> DataFrame:
    return schema_diff(schemas).agg(F.count("*").alias("n_mismatches"))
