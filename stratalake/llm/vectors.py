"""Vector columns as numpy matrices, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of rows in the batch, their vectors as doubles), one pair a length.

    Null and empty vectors and those with null or non-finite components are left out.
    """
    lists = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    # The content of null lists is not among the values; nulls among them become NaN.
    values = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    for dims in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dims)
        own = values[starts[rows][:, None] + np.arange(dims)]
        finite = np.isfinite(own).all(axis=1)
        if finite.any():
            yield rows[finite], own[finite]


def floored(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component as a 64-bit integer."""
    scaled = np.floor(vectors * scale)
    if np.abs(scaled).max(initial=0) >= 1 << 62:
        raise OverflowError("a component does not fit 64 bits")
    return scaled.astype(np.int64)
