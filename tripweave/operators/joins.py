"""Joining rows to a small table whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table with no more rows than this is copied to every executor.
BROADCAST_ROWS = 100_000

# Rows of one key that one task should get when the table is too large for that.
KEY_ROWS = 1_000_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows; reads no further than that."""
    return df.limit(rows + 1).count() <= rows


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    small: bool,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Left join to a table with unique keys.

    Beyond the broadcast size, rows of keys with more than `key_rows` of them are
    salted, and only their table rows copied, as often as the counted rows of
    the key need. One more scan of the key column counts them.
    """
    if small:
        return rows.join(F.broadcast(table), F.col(key) == F.col(table_key), "left")
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    # At most rows / key_rows of these, a few bytes each.
    hot = counts.where(F.col("_n") > key_rows).select(
        F.col(key).alias("_hot"), F.expr(f"_n div {key_rows} + 1").alias("_salts")
    )
    if is_small(hot):
        hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    salted_rows = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*rows.columns), salts)
    )
    salted_rows = salted_rows.drop("_hot", "_salts")
    copied = table.join(hot, F.col(table_key) == F.col("_hot"), "left")
    copies = copied.withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    ).drop("_hot", "_salts")
    match = (F.col(key) == F.col(table_key)) & (F.col("_salt") == F.col("_copy"))
    return salted_rows.join(copies, match, "left").drop("_salt", "_copy")
