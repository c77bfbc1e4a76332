"""Vector columns: Arrow <-> numpy, int8 codes, exact pair scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "dot", "l2")


def to_matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows x dim matrix of a list column whose rows all have ``dim`` elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), dim)


def to_lists(matrix: np.ndarray, arrow_type: pa.DataType) -> pa.ListArray:
    rows, dim = matrix.shape
    offsets = pa.array(np.arange(0, rows * dim + 1, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1)).cast(arrow_type))


def score_block(metric: str, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores of every row against every query, higher is better, rounded to 6 decimals."""
    if metric == "l2":
        raw = np.empty((len(rows), len(queries)))
        for i, query in enumerate(queries):  # expanded squares would lose digits of near vectors
            apart = rows - query
            raw[:, i] = -np.sqrt(np.einsum("ij,ij->i", apart, apart))
    else:
        raw = rows @ queries.T
        if metric == "cosine":
            norms = np.sqrt((rows**2).sum(1))[:, None] * np.sqrt((queries**2).sum(1))[None, :]
            raw = np.divide(raw, norms, out=np.zeros_like(raw), where=norms > 0)
    return np.floor(raw * 1e6 + 0.5) / 1e6


def pair_score(metric: str, a: Column, b: Column) -> Column:
    """Score of one pair of vectors inside the JVM; for short candidate lists."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    def dot(x: Column, y: Column) -> Column:
        return total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))

    if metric == "l2":
        diff = F.zip_with(a, b, lambda p, q: p.cast("double") - q.cast("double"))
        return F.round(-F.sqrt(total(F.transform(diff, lambda d: d * d))), 6)
    if metric == "dot":
        return F.round(dot(a, b), 6)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, F.round(dot(a, b) / norm, 6)).otherwise(F.lit(0.0))


def usable(values: Column, dim: int | Column) -> Column:
    """Whether a vector has ``dim`` elements, all finite; never null."""
    finite = F.forall(values, lambda x: F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce((F.size(values) == dim) & finite, F.lit(False))


def int8_codes(values: Column) -> Column:
    """``STRUCT<codes, scale>``: each row scaled by its largest magnitude to -127..127."""

    @F.arrow_udf("struct<codes:array<tinyint>,scale:double>")
    def encode(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], pa.struct([("codes", pa.list_(pa.int8())), ("scale", pa.float64())]))
        rows = to_matrix(batch, len(batch[0]))
        peak = np.abs(rows).max(1)
        peak = np.where(peak > 0, peak, 1.0)
        codes = np.floor(127.0 * rows / peak[:, None] + 0.5).astype(np.int8)
        return pa.StructArray.from_arrays([to_lists(codes, pa.int8()), pa.array(peak / 127.0)], ["codes", "scale"])

    return encode.asNondeterministic()(values)
