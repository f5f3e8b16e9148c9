"""Zone coordinates from CSV, outline vertices, and report output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.text import leading_double, leading_int, unquote
from tripweave.operators.zones import find_location_column, last_per_zone, or_fallback


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """`LocationID, longitude, latitude` lines; the last usable line of an id wins.

    A heading, a line with fewer than three fields or with a field that does not
    start with a number is skipped. With no usable line at all, four built-in
    zones are returned.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return or_fallback(last_per_zone(parse_zones(lines), ["_file", "_block", "_line"]))


def parse_zones(lines: DataFrame, text: str = "value") -> DataFrame:
    """Replace a line of text by the zone it describes; lines that describe none are dropped."""
    fields = F.transform(F.split(text, ","), unquote)
    other = [c for c in lines.columns if c != text]
    return lines.select(
        leading_int(F.get(fields, 0)).alias("LocationID"),
        leading_double(F.get(fields, 1)).alias("longitude"),
        leading_double(F.get(fields, 2)).alias("latitude"),
        *other,
    ).dropna(subset=["LocationID", "longitude", "latitude"])


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    """Outline vertices in planar feet, from CSV with a header or from Parquet.

    CSV columns are found by the names in the header, whatever their order; a
    number that isn't one becomes null.
    """
    if not path.endswith(".csv"):
        return spark.read.parquet(path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    kinds = {"shape_seq": "bigint", find_location_column(raw): "string", "x": "double", "y": "double"}
    missing = [name for name in kinds if name not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return raw.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in kinds.items()])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, replacing what was there; lists are joined by `|`."""
    columns = [
        F.array_join(name, "|").alias(name) if kind.startswith("array") else F.col(name)
        for name, kind in df.dtypes
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)
