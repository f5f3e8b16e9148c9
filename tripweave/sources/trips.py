"""Reading monthly trip files whose schemas differ, and writing trips by month."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.times import from_micros, in_period, period_from_name, period_number, whole_div
from tripweave.operators.clean import conform
from tripweave.schema import PICKUP, SOURCE_FILE, SOURCE_ROW, TRIP_ALIASES, TRIP_SCHEMA

# File column types and the Spark types they are read as.
READ_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "large_string": T.StringType(),
    "date32[day]": T.DateType(),
    "date64[ms]": T.DateType(),
}


def read_type(name: str) -> T.DataType | None:
    """How to read a file column; None for one with no values or of an unknown type."""
    dictionary = re.match(r"dictionary<values=(\w+)", name)
    name = dictionary.group(1) if dictionary else name
    if name == INT96:
        return T.TimestampType()
    if is_nanos(name):
        return T.LongType()
    if name.startswith("timestamp["):
        return T.TimestampType() if "tz=" in name else T.TimestampNTZType()
    decimal = re.match(r"decimal(?:32|64|128)\((\d+), (\d+)\)", name)
    if decimal:
        return T.DecimalType(int(decimal.group(1)), int(decimal.group(2)))
    return READ_TYPES.get(name)


# A timestamp of twelve bytes; files say so only in the physical type.
INT96 = "int96"


def is_nanos(name: str) -> bool:
    return name.startswith("timestamp[ns")


def layouts(footers: DataFrame, columns: list[str], by_period: bool = False) -> dict[tuple, list[str]]:
    """Files by how they store the wanted columns: ((column, type), ...) -> paths.

    With `by_period` also by the month that their names are labelled with:
    (layout, yyyymm or None) -> paths. The driver gets one row per file, as it
    does when it lists files for a scan.
    """
    kind = F.when(F.col("physical") == "INT96", INT96).otherwise(F.col("type")).alias("type")
    pair = F.when(F.col("column").isin(columns), F.struct("column", kind))
    per_file = footers.groupBy("path").agg(F.array_sort(F.collect_set(pair)).alias("layout"))
    per_file = per_file.withColumn("period", period_number(F.substring_index("path", "/", -1)))
    groups: dict[tuple, list[str]] = {}
    for row in per_file.orderBy("path").toLocalIterator():
        layout = tuple((c.column, c.type) for c in row.layout)
        groups.setdefault((layout, row.period) if by_period else layout, []).append(row.path)
    return groups


def read_layout(
    spark: SparkSession,
    layout: tuple,
    paths: list[str],
    skip_unreadable: bool = False,
    keep: Collection[str] = (),
) -> DataFrame:
    """Files of one layout, with the file and row each row came from.

    `keep` names those of the two that are stored columns and stay as they are.
    """
    fields = [T.StructField(c, read_type(t)) for c, t in layout if read_type(t) is not None]
    # A path is also a pattern, so its special signs are escaped.
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]
    raw = (
        spark.read.schema(T.StructType(fields))
        .option("ignoreCorruptFiles", skip_unreadable)
        .parquet(*literal)
    )
    extra = {
        SOURCE_FILE: F.col("_metadata.file_path"),
        SOURCE_ROW: F.col("_metadata.row_index"),
    }
    extra = {name: value for name, value in extra.items() if name not in keep}
    for column, kind in layout:
        if is_nanos(kind):
            extra[column] = from_micros(whole_div(F.col(column), 1000))
        elif read_type(kind) is None:
            extra[column] = F.lit(None)
    return raw.withColumns(extra)


def read_files(
    footers: DataFrame,
    columns: list[str],
    shape: Callable[[DataFrame], DataFrame],
    skip_unreadable: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """All rows of files whose schemas differ, each layout brought to one shape first.

    With `skip_unreadable`, what cannot be decoded costs the rest of its split;
    `split_bytes` makes splits smaller than the session would.
    """
    spark = footers.sparkSession if split_bytes is None else with_splits(footers.sparkSession, split_bytes)
    groups = layouts(footers, columns)
    if not groups:
        raise ValueError("no files to read")
    parts = [shape(read_layout(spark, k, paths, skip_unreadable)) for k, paths in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def with_splits(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session that differs from `spark` in the size of its splits only; what it reads is joined to others' as usual."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return session


def read_as_stored(footers: DataFrame) -> DataFrame:
    """All rows with every column that any file has, null where a file has none.

    Rows that already say which file and row they first came from keep saying so.
    """
    found = footers.where(F.col("column").isNotNull()).select("column").distinct().collect()
    columns = sorted(row.column for row in found)
    spark = footers.sparkSession
    groups = layouts(footers, columns)
    if not groups:
        raise ValueError("no files to read")
    parts = []
    for layout, paths in groups.items():
        stored = {column for column, _ in layout}
        parts.append(read_layout(spark, layout, paths, keep=stored & {SOURCE_FILE, SOURCE_ROW}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_trips(
    footers: DataFrame,
    target: T.StructType = TRIP_SCHEMA,
    aliases: dict[str, list[str]] = TRIP_ALIASES,
    pickup: str | None = None,
) -> DataFrame:
    """All rows in the target schema, with the file and row they came from.

    With `pickup`, only those whose time of this name lies in the month that
    their file's name is labelled with, if it is: files of one month are one
    scan, filtered by a range of literal times, so that row groups beyond it
    are skipped by their statistics.
    """
    wanted = [name for f in target.fields for name in [f.name, *aliases.get(f.name, [])]]

    def shape(raw: DataFrame) -> DataFrame:
        return conform(raw, target, aliases, (SOURCE_FILE, SOURCE_ROW))

    if pickup is None:
        return read_files(footers, wanted, shape)
    groups = layouts(footers, wanted, by_period=True)
    if not groups:
        raise ValueError("no files to read")
    parts = []
    for (layout, period), paths in groups.items():
        rows = shape(read_layout(footers.sparkSession, layout, paths))
        parts.append(rows if period is None else rows.where(in_period(F.col(pickup), period)))
    return reduce(DataFrame.unionByName, parts)


def write_by_month(df: DataFrame, path: str, ts: str = PICKUP) -> None:
    """Parquet with zstd in `year=`/`month=` folders, by the month of the source file's name.

    Where that names none, by the time itself. No shuffle: a task holds rows of
    few months, as each input file covers one.
    """
    year, month = F.year(ts), F.month(ts)
    if SOURCE_FILE in df.columns:
        of_file = period_from_name(F.substring_index(SOURCE_FILE, "/", -1))
        # Both from the name or neither.
        year, month = (F.coalesce(own, part) for own, part in zip(of_file, (year, month), strict=True))
    (
        df.withColumns({"year": year, "month": month})
        .write.partitionBy("year", "month")
        .option("compression", "zstd")
        .mode("overwrite")
        .parquet(path)
    )


def preview(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """The first rows of a file, to look at."""
    return spark.read.parquet(path).limit(rows)
