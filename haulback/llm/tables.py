"""What the operators share: reading ``documents``, and Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows handed on at once by a Python task.
ROWS = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def columns(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, a few hundred at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = ROWS, weight=None, most_weight: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``most`` rows, or fewer where ``weight`` (bytes of a row) adds up."""
    held: list[tuple] = []
    heavy = 0
    for row in rows:
        held.append(row)
        heavy += weight(row) if weight else 0
        if len(held) >= most or heavy >= most_weight:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
