"""Vectors of an Arrow column as a matrix, with what cannot be used left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_width(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, matrix) for each width of the lists of `column`: those whose entries are all finite numbers.

    Null and empty lists and lists with a null, NaN or infinite entry are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for width in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == width)
        flat = column.take(pa.array(places)).flatten().cast(pa.float64())
        matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
        whole = np.isfinite(matrix).all(axis=1)
        yield width, places[whole], matrix[whole]


def of_width(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix of the usable lists of one width."""
    for found, places, matrix in by_width(column):
        if found == width:
            return places, matrix
    return np.zeros(0, np.int64), np.zeros((0, width))


def binary(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as the bytes of its entries."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(matrix)], pa.binary())


def matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """The reverse of `binary`, for rows without null."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)
