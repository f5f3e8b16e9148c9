"""Letting Python workers find the library."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
USUAL_BATCH = "67108864b"

# Bytes of rows that come to a Python worker at a time.
BATCH_BYTES = 8 << 20

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_library(spark: SparkSession) -> SparkSession:
    """Workers look for modules where the driver found this one, too.

    Enough on one machine, whatever folder the driver was started in; on a
    cluster the library is installed, or sent with --py-files.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> SparkSession:
    """Rows come to Python workers in batches of about `size` bytes, unless the session sets another limit.

    So many, and a few times as much while it is converted, is what a worker
    and the JVM beside it hold at a time, however long the texts are.
    """
    if spark.conf.get(BATCH_SETTING, USUAL_BATCH) == USUAL_BATCH:
        spark.conf.set(BATCH_SETTING, str(size))
    return spark
