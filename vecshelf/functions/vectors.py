"""Vector expressions over array columns, run on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.functions.text import hash_number

from vecshelf.constants import EPS_NORM

DOUBLES = T.ArrayType(T.DoubleType())


def to_matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow list column as a float64 matrix; all rows must have one length and no null."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = len(vectors)
    if rows == 0:
        return np.zeros((0, 0))
    if vectors.null_count:
        raise ValueError("null vector")
    sizes = pc.unique(pc.list_value_length(vectors))
    if len(sizes) != 1:
        raise ValueError(f"vectors of different length: {sizes.to_pylist()}")
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("null value in a vector")
    values = flat.to_numpy(zero_copy_only=False)
    return values.astype(np.float64, copy=False).reshape(rows, sizes[0].as_py())


def from_matrix(matrix: np.ndarray, kind: pa.DataType = pa.float64()) -> pa.ListArray:
    rows, dim = matrix.shape
    offsets = np.arange(0, (rows + 1) * dim, dim) if dim else np.zeros(rows + 1, dtype=np.int64)
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), type=kind)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def unit_rows(matrix: np.ndarray, eps: float = EPS_NORM) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.maximum(norms, eps)[:, None]


def l2_normalise(vector: Column, eps: float = EPS_NORM) -> Column:
    """Scale to unit length; a zero vector stays zero."""

    @F.arrow_udf(DOUBLES)
    def normalise(v: pa.Array) -> pa.Array:
        return from_matrix(unit_rows(to_matrix(v), eps))

    return normalise(vector)


def project(vector: Column, weights: np.ndarray, bias: np.ndarray | None = None) -> Column:
    """`vector · weights (+ bias)`, with `weights` a driver-side model matrix `[in, out]`."""
    matrix = np.asarray(weights, dtype=np.float64)
    shift = None if bias is None else np.asarray(bias, dtype=np.float64)

    @F.arrow_udf(DOUBLES)
    def linear(v: pa.Array) -> pa.Array:
        out = to_matrix(v) @ matrix if len(v) else np.zeros((0, matrix.shape[1]))
        return from_matrix(out if shift is None else out + shift)

    return linear(vector)


def mix64(state: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (the splitmix64 finaliser)."""
    z = state.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def dropout_rows(matrix: np.ndarray, draws: np.ndarray, p: float) -> np.ndarray:
    """Zero each value with probability `p`, as a function of the row's draw and the position."""
    if p <= 0.0:
        return matrix
    steps = np.arange(1, matrix.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    noise = mix64(draws.astype(np.int64).view(np.uint64)[:, None] + steps[None, :])
    keep = (noise >> np.uint64(11)).astype(np.float64) * 2.0**-53 >= p
    return np.where(keep, matrix / (1.0 - p), 0.0)


def dropout(vector: Column, row_id: Column, p: float, seed: int, step: int) -> Column:
    """Dropout whose mask depends on (row, position, step, seed) only, not on partitioning."""

    @F.arrow_udf(DOUBLES)
    def drop(v: pa.Array, draws: pa.Array) -> pa.Array:
        return from_matrix(dropout_rows(to_matrix(v), draws.to_numpy(zero_copy_only=False), p))

    return drop(vector, dropout_draw(row_id, seed, step))


def dropout_draw(row_id: Column, seed: int, step: int) -> Column:
    return hash_number(row_id, F.lit(seed), F.lit(step))


def content_key(vector: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together name a vector by content (0.0 and -0.0 agree)."""
    return F.xxhash64(vector), F.xxhash64(F.lit("second"), vector)
