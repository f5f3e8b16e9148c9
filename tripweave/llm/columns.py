"""Columns that pass through an Arrow step beside the text it works on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def with_columns(
    docs: DataFrame, added: dict[str, str | T.DataType], step: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """Add columns that `step` makes of each batch's texts, one array a column.

    Other columns pass through whatever their names; those named like an added
    one are replaced.
    """
    others = [name for name in docs.columns if name != "text" and name not in added]
    held = docs.select(
        F.col("text").cast("string").alias("text"),
        F.struct(F.lit(True).alias("a_row"), *[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(others)]).alias("rest"),
    )
    schema = T.StructType([*held.schema.fields])
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *step(batch.column(0))], names=schema.names)

    shown = [
        F.col("text") if name == "text" else F.col("rest").getField(f"c{others.index(name)}").alias(name)
        for name in docs.columns
        if name not in added
    ]
    return held.mapInArrow(run, schema).select(*shown, *added)
