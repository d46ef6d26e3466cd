"""Vectors of Arrow list columns as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and rows in double precision, one matrix for each length that occurs above zero.

    Null entries become NaN; null rows are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        yield rows, flat[starts[rows][:, None] + np.arange(length)]


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither tiny nor huge entries are lost. Zero rows become NaN."""
    with np.errstate(invalid="ignore", divide="ignore"):
        scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
        return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
