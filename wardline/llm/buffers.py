"""Texts of an Arrow batch as flat byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def utf8_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` for runs of rows of at most ``limit`` bytes, or one longer
    row. Null is the empty text. Keeps the numpy work on a batch bounded, however long the batch is."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_utf8())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def rows_of(batch: pa.RecordBatch, first: int, end: int, names: list[str]) -> dict[str, pa.Array]:
    """Some columns of a run of rows, unchanged."""
    return {n: batch.column(batch.schema.get_field_index(n)).slice(first, end - first) for n in names}
