"""Listing Parquet files, and what their footers say."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.functions.times import month_index, period_from_name, period_label
from tripweave.session import store

FOOTER_SCHEMA = (
    "path string, n_rows bigint, group_bytes bigint, pos int, column string, type string, physical string"
)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every `*.parquet` below `root`: path, name, length, modified, label, year, month.

    Empty ones have length 0; what begins with `_` or `.` is left out.
    Executors list folders, a level at a time, so neither names nor sizes pass
    through the driver; a level's result is stored.
    """
    locate = locator()

    def listed(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch["path"]:
                system, inner = locate(path)
                info = system.get_file_info(inner)
                if info.type == fs.FileType.NotFound:
                    raise FileNotFoundError(path)
                if info.type == fs.FileType.File:
                    rows.append((path, info.size, info.mtime, False))
                    continue
                for found in system.get_file_info(fs.FileSelector(inner)):
                    if not found.base_name.startswith(("_", ".")):
                        is_folder = found.type == fs.FileType.Directory
                        inside = f"{path.rstrip('/')}/{found.base_name}"
                        rows.append((inside, 0 if is_folder else found.size, found.mtime, is_folder))
            frame = pd.DataFrame(rows, columns=["path", "length", "modified", "is_folder"])
            frame["modified"] = pd.to_datetime(frame["modified"], utc=True).dt.tz_localize(None)
            yield frame.astype({"length": "Int64", "is_folder": "boolean"})

    slots = spark.sparkContext.defaultParallelism
    start = qualified(root)
    level, parts = spark.createDataFrame([(start,)], "path string"), []
    while True:
        found = level.mapInPandas(listed, "path string, length bigint, modified timestamp, is_folder boolean")
        found = store(found, "listed")
        parts.append(found.where(~F.col("is_folder") & F.col("path").endswith(".parquet")).drop("is_folder"))
        folders = found.where("is_folder").select("path")
        if folders.isEmpty():
            return with_period(reduce(DataFrame.unionByName, parts))
        level = folders.repartition(slots, "path")


def qualified(path: str) -> str:
    """A path the way a scan reports it: `/x` and `file:///x` as `file:/x`."""
    if "://" not in path and not path.startswith("file:"):
        return f"file:{os.path.abspath(path)}"
    scheme, _, rest = path.partition(":///")
    return (f"{scheme}:/{rest}" if rest else path).rstrip("/")


def locator():
    """A function for use in tasks: the file system and inner path of a path; keeps each system it has opened."""
    systems = {}

    def locate(path: str):
        import re
        from urllib.parse import quote

        from pyarrow import fs

        if path.startswith("file:/"):
            path = "/" + path[len("file:/") :].lstrip("/")
        if "://" not in path:
            return fs.LocalFileSystem(), path
        # Spark's names for the S3 scheme are not known outside it.
        uri = quote(re.sub("^s3[an]:", "s3:", path), safe=":/@")
        scheme, _, rest = uri.partition("://")
        place = f"{scheme}://{rest.partition('/')[0]}"
        if place not in systems:
            systems[place] = fs.FileSystem.from_uri(uri)[0]
        inner = path.partition("://")[2]
        # Object stores name the bucket in the path, file systems with hosts don't.
        if scheme not in ("s3", "gs", "gcs", "abfs", "abfss"):
            inner = "/" + inner.partition("/")[2]
        return systems[place], inner

    return locate


def dataset_path(path: Column, root: str) -> Column:
    """The outermost folder below `root` named `*.parquet` that a listed file is part of, else the file itself."""
    start = qualified(root)
    inside = F.regexp_extract(F.substr(path, F.lit(len(start) + 1)), r"(?s)^.*?\.parquet(?=/|\z)", 0)
    return F.concat(F.lit(start), inside)


def datasets(files: DataFrame, root: str) -> DataFrame:
    """Listed files with those of one folder named `*.parquet` as one: its path, their total length, the last change."""
    whole = files.groupBy(dataset_path(F.col("path"), root).alias("path")).agg(
        F.sum("length").alias("length"), F.max("modified").alias("modified")
    )
    return with_period(whole)


def dataset_footers(footers: DataFrame, root: str) -> DataFrame:
    """Footers with the files of one folder named `*.parquet` as one.

    It has the rows of all its files, and each column once per type. Rows are
    summed over the first column of each file, which every file has once.
    """
    first = F.coalesce("pos", F.lit(0)) == 0
    columns = footers.groupBy(
        dataset_path(F.col("path"), root).alias("path"), "column", "type", "physical"
    ).agg(
        F.sum(F.when(first, F.col("n_rows"))).alias("n_rows"),
        F.min("group_bytes").alias("group_bytes"),
        F.min("pos").alias("pos"),
    )
    whole = Window.partitionBy("path")
    counted = columns.withColumns(
        {"n_rows": F.sum("n_rows").over(whole), "group_bytes": F.min("group_bytes").over(whole)}
    )
    return counted.select(*footers.columns)


def listed_path(scanned: Column) -> Column:
    """The listed path of a file that a scan names in encoded form."""
    return F.url_decode(F.replace(scanned, F.lit("+"), F.lit("%2B")))


def with_period(files: DataFrame) -> DataFrame:
    """Add the file name, its label and its (year, month)."""
    year, month = period_from_name(F.col("name"))
    return files.withColumn("name", F.substring_index("path", "/", -1)).withColumns(
        {"label": period_label(F.col("name")), "year": year, "month": month}
    )


def in_period_range(
    files: DataFrame, start: tuple[int, int], end: tuple[int, int]
) -> DataFrame:
    """Files from month `start` to month `end`, both included; unlabelled ones are left out."""
    at = month_index(F.col("year"), F.col("month"))
    return files.where(at.between(start[0] * 12 + start[1], end[0] * 12 + end[1]))


def with_status(files: DataFrame, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """Add `status`: processed, skipped_empty or skipped_out_of_range."""
    at = month_index(F.col("year"), F.col("month"))
    inside = F.coalesce(
        at.between(start[0] * 12 + start[1], end[0] * 12 + end[1]), F.lit(False)
    )
    status = (
        F.when(~inside, "skipped_out_of_range")
        .when(F.col("length") == 0, "skipped_empty")
        .otherwise("processed")
    )
    return files.withColumn("status", status)


def status_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("status").agg(F.count("*").alias("n_files"))


def read_footers(files: DataFrame, skip_unreadable: bool = False) -> DataFrame:
    """One row per file and column, with the file's row count, from footers alone.

    `group_bytes` is the stored size of the smallest row group, null without any;
    `type` is the type the file was written with, `physical` how it is stored
    (null for a nested column). A file without columns yields one row with a
    null column, and one whose footer cannot be decoded, if those are to be
    skipped, also a null row count; one that isn't there or may not be read
    always raises. Empty files are left out.
    """

    locate = locator()

    def footers(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        def smallest_group(metadata):
            groups = [metadata.row_group(i) for i in range(metadata.num_row_groups)]
            sizes = [sum(g.column(j).total_compressed_size for j in range(g.num_columns)) for g in groups]
            return min(sizes, default=None)

        def open_file(path):
            system, inner = locate(path)
            return system.open_input_file(inner)

        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    with open_file(path) as handle:
                        parquet = pq.ParquetFile(handle)
                        n_rows, schema = parquet.metadata.num_rows, parquet.schema_arrow
                        group_bytes = smallest_group(parquet.metadata)
                        leaves = [parquet.schema.column(i) for i in range(len(parquet.schema))]
                        stored = {leaf.path: leaf.physical_type for leaf in leaves}
                except (pa.ArrowException, OSError) as error:
                    gone = isinstance(error, (FileNotFoundError, PermissionError))
                    if gone or not skip_unreadable:
                        raise
                    n_rows, group_bytes, schema, stored = None, None, [], {}
                if len(schema) == 0:
                    rows.append((path, n_rows, group_bytes, None, None, None, None))
                for pos, field in enumerate(schema):
                    kind = stored.get(field.name)
                    rows.append((path, n_rows, group_bytes, pos, field.name, str(field.type), kind))
            names = ["path", "n_rows", "group_bytes", "pos", "column", "type", "physical"]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"n_rows": "Int64", "group_bytes": "Int64", "pos": "Int32"})

    slots = files.sparkSession.sparkContext.defaultParallelism
    spread_out = files.where(F.col("length") > 0).select("path").repartition(slots, "path")
    return spread_out.mapInPandas(footers, FOOTER_SCHEMA)


def with_folder_period(files: DataFrame) -> DataFrame:
    """Files in `year=`/`month=` folders take those as their period instead of one in their name."""
    folders = r"/year=(\d+)/month=(\d+)/"
    of_folder = [F.regexp_extract("path", folders, i).try_cast("int") for i in (1, 2)]
    return files.withColumns({"year": F.coalesce(of_folder[0], "year"), "month": F.coalesce(of_folder[1], "month")})


def short_files(footers: DataFrame, read: DataFrame) -> DataFrame:
    """Files of which fewer rows could be read than their footers say, with their smallest row group.

    `read` has path and n_read.
    """
    files = footers.where(F.col("n_rows") > 0).groupBy("path").agg(
        F.max("n_rows").alias("n_rows"), F.max("group_bytes").alias("group_bytes")
    )
    counted = files.join(read, "path", "left")
    return counted.where(F.coalesce("n_read", F.lit(0)) < F.col("n_rows")).select("path", "group_bytes")


STATE = ["path", "length", "modified"]


def known_footers(files: DataFrame, manifest: str, skip_unreadable: bool = False) -> DataFrame:
    """What `read_footers` returns, from a folder that keeps it for files that haven't changed.

    A file is the same if its path, length and time of change are. Of others
    the footers are read, and added to the folder; what is there is never
    rewritten, so that a job that fails or runs twice leaves it right. Files
    whose footers could not be decoded are tried again unless they may be skipped.
    """
    spark = files.sparkSession
    schema = f"{FOOTER_SCHEMA}, length bigint, modified timestamp"
    # An empty part, so that there is a folder to read.
    spark.createDataFrame([], schema).write.mode("append").parquet(manifest)
    kept = spark.read.schema(schema).parquet(manifest).dropDuplicates([*STATE, "pos"])
    if not skip_unreadable:
        kept = kept.where(F.col("n_rows").isNotNull())
    present = files.where(F.col("length") > 0)
    fresh = store(present.join(kept, STATE, "left_anti").select(*STATE), "fresh-files")
    if not fresh.isEmpty():
        read = read_footers(fresh, skip_unreadable).join(fresh, "path")
        read.select(*kept.columns).write.mode("append").parquet(manifest)
        return known_footers(files, manifest, skip_unreadable)
    return kept.join(present.select(*STATE), STATE, "left_semi").drop("length", "modified")


def file_schemas(footers: DataFrame) -> DataFrame:
    """(path, label, pos, column, type) of every column of every file."""
    name = F.substring_index("path", "/", -1)
    return footers.where(F.col("column").isNotNull()).select(
        "path", period_label(name).alias("label"), "pos", "column", "type"
    )


def file_counts(footers: DataFrame) -> DataFrame:
    """Rows of each labelled file: year, month, file, row_count."""
    counts = footers.groupBy("path").agg(F.max("n_rows").alias("row_count"))
    return (
        with_period(counts)
        .where(F.col("year").isNotNull())
        .select("year", "month", F.col("path").alias("file"), "row_count")
    )


def ingested_rows(
    footers: DataFrame, required: list[str], taken: DataFrame | None = None
) -> DataFrame:
    """Per file: its rows, the needed columns it lacks, the rows a job took and those it lost.

    `taken` has path and n_taken, counted on what the job wrote; without it both
    counts are null. The footer's row count is null for a file that has no readable
    footer.
    """
    rows = per_file_columns(footers, required)
    if taken is None:
        unknown = F.lit(None).cast("bigint")
        return rows.withColumns({"n_ingested": unknown, "n_lost": unknown})
    counted = rows.join(taken, "path", "left")
    n_ingested = F.coalesce("n_taken", F.lit(0).cast("bigint"))
    return counted.withColumn("n_ingested", n_ingested).select(
        *rows.columns, "n_ingested", (F.col("n_rows") - F.col("n_ingested")).alias("n_lost")
    )


def per_file_columns(footers: DataFrame, required: list[str]) -> DataFrame:
    """Per file: path, n_rows, and the needed columns that it lacks."""
    per_file = footers.groupBy("path").agg(
        F.max("n_rows").alias("n_rows"), F.collect_set("column").alias("_present")
    )
    needed = F.array(*[F.lit(name) for name in required])
    return per_file.select(
        "path", "n_rows", F.array_except(needed, "_present").alias("missing")
    )


def missing_columns(footers: DataFrame, required: list[str]) -> DataFrame:
    """Files that lack one of the columns a job needs, with what they lack."""
    lacking = per_file_columns(footers, required)
    return lacking.where(F.size("missing") > 0).select("path", "missing")
