"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Wall-clock times carry no zone and are written out as UTC.
TIME_ZONE = "UTC"

SETTINGS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    "spark.sql.ansi.enabled": "true",
    # Files may hold columns that differ by the case of a letter only.
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A nanosecond column is read as a plain count and scaled by the epoch rule.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Of a JSON field that comes twice the last counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Rows that a task should get at most ahead of a step that multiplies them or takes long for each.
SPREAD_ROWS = 25_000


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tripweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` names use `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return apply_settings(builder.getOrCreate())


def work_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripweave-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the work folder and read it back, cutting its lineage.

    Row positions drawn while writing stay fixed, whatever is recomputed later.
    `compression` is a codec other than the session's, as for whole texts.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Rows of a plain scan over all cores, where it has fewer splits than cores.

    For small inputs ahead of a step that multiplies rows; a large scan has more
    splits than cores and is left as it is. With `rows`, how many there are, they
    are dealt in any case, over as many tasks as keep each to `SPREAD_ROWS`: a
    file may have fewer row groups than splits, and few splits for what its rows
    become.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        return df.repartition(max(cores, -(-rows // SPREAD_ROWS)), *keys)
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
