"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

#: Bytes of text that are turned into Python objects at once.
SLICE_BYTES = 8 << 20


def text_column(name: str = "text"):
    """The whole text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def column(name: str):
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def raw(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice's texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        size = batch.column(column).nbytes
        if size <= limit:
            if batch.num_rows:
                yield batch
            continue
        step = max(1, batch.num_rows * limit // size)
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, step)
            while part.num_rows > 1 and part.column(column).nbytes > 2 * limit:
                part = part.slice(0, (part.num_rows + 1) // 2)
            yield part
            start += part.num_rows


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


