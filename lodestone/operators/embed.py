"""Texts to vectors.

Embedders are marked non-deterministic although equal texts give equal vectors: otherwise a
filter on the vector would move below the projection and run the embedder twice. Filter
records on their metadata before embedding them.

The built-in embedder hashes tokens into ``dim`` buckets and scales the counts to unit length.
It stands in for a learned model, none of which is available offline: it is exact and
reproducible but knows nothing about meaning. Other models are registered by provider and name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import hash_bucket, tokens
from lodestone.functions.vectors import to_lists
from lodestone.workers import lean, small_batches

HASHING = ("local", "hashing")
DEFAULT_DIM = 64
_CELLS = 4_000_000

# Vector length of known hosted models, by provider and model.
MODEL_DIMS = {
    ("local", "hashing"): 64,
    ("default", "embedding-4b"): 2560,
    ("openai", "text-embedding-3-small"): 1536,
    ("openai", "text-embedding-3-large"): 3072,
}

_embedders: dict[tuple[str, str], tuple[int, Callable[[list[str]], np.ndarray]]] = {}


def register_embedder(
    provider: str, model: str, dim: int, fn: Callable[[list[str]], np.ndarray]
) -> None:
    """Make ``fn`` (a batch of texts -> a rows x dim matrix) the embedder of provider/model."""
    _embedders[(provider, model)] = (dim, fn)


def infer_dim(provider: str, model: str) -> int | None:
    """Vector length of a known or registered model."""
    if (provider, model) in _embedders:
        return _embedders[(provider, model)][0]
    return MODEL_DIMS.get((provider, model))


def hashing_vector(text: Column, dim: int = DEFAULT_DIM) -> Column:
    """Hashed token counts of unit length; text without tokens gives the zero vector.

    Tokens and buckets are computed in the JVM; only bucket numbers cross to Python, where a
    batch becomes one histogram. Nothing is shuffled.
    """

    def histogram(buckets: pa.Array) -> pa.Array:
        lengths = pc.list_value_length(buckets).fill_null(0).to_numpy()
        flat = buckets.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        step = max(1, _CELLS // dim)
        parts = []
        for start in range(0, len(buckets), step):
            n = lengths[start : start + step]
            low = ends[start] - lengths[start]
            part = flat[low : low + n.sum()]
            cells = np.repeat(np.arange(len(n)), n) * dim + part
            counts = np.bincount(cells, minlength=len(n) * dim).reshape(len(n), dim).astype(np.float64)
            norm = np.sqrt((counts**2).sum(1, keepdims=True))
            parts.append(np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0))
        matrix = np.concatenate(parts) if parts else np.zeros((0, dim))
        return to_lists(matrix, pa.float32())

    @F.arrow_udf("array<float>")
    @lean
    def count_buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(histogram, batches)

    return count_buckets.asNondeterministic()(F.transform(tokens(text), lambda t: hash_bucket(t, dim)))


def _model_vector(text: Column, dim: int, fn: Callable[[list[str]], np.ndarray]) -> Column:
    """Vectors by a registered model, which sees every distinct text of a batch once."""

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        if len(texts) == 0:
            return pa.array([], pa.list_(pa.float32()))
        coded = texts.fill_null("").dictionary_encode()
        matrix = np.asarray(fn(coded.dictionary.to_pylist()), dtype=np.float32)
        if matrix.shape != (len(coded.dictionary), dim):
            raise ValueError(f"embedder returned shape {matrix.shape}, expected {(len(coded.dictionary), dim)}")
        return to_lists(matrix[coded.indices.to_numpy()], pa.float32())

    return run.asNondeterministic()(text)


def embed_texts(
    df: DataFrame,
    text: str = "text",
    out: str = "values",
    provider: str = HASHING[0],
    model: str = HASHING[1],
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Add ``out``: one vector per row, equal for equal texts.

    Rows are embedded where they are, without a shuffle, so a text with very many copies skews
    nothing. A registered model runs once per distinct text of an Arrow batch.
    """
    if (provider, model) == HASHING:
        small_batches(df.sparkSession)
        return df.withColumn(out, hashing_vector(F.col(text), dim))
    if (provider, model) not in _embedders:
        raise ValueError(f"no embedder registered for {provider}/{model}")
    size, fn = _embedders[(provider, model)]
    return df.withColumn(out, _model_vector(F.col(text), size, fn))
