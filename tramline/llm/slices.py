"""Arrow batches cut by bytes of text, so that a step's memory follows the longest text and not the row count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a step takes; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def by_bytes(batches, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of the batches: as many rows as ``limit`` bytes of ``column`` hold, one at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        upto = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def sums_by_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches values[ends[i]:ends[i + 1]], empty ones 0, in 64-bit integers."""
    upto = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=upto[1:])
    return upto[ends[1:]] - upto[ends[:-1]]
