"""Arrow batches cut so that a slice holds a bounded number of text bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4_000_000


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``most`` bytes of text at most, or a single longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of a string column end to end, offsets of its rows in them); null is empty."""
    column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offset_buffer, data = column.buffers()
    ends = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]
