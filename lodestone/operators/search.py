"""Search over a collection: request defaults, text, hybrid, rerank, projection, union."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.text import tokens
from lodestone.functions.vectors import pair_score, usable
from lodestone.operators.dense import DEFAULT_TOP_K, vector_search
from lodestone.operators.embed import DEFAULT_DIM, HASHING, embed_texts
from lodestone.operators.sparse import Asked, SparseIndex
from lodestone.operators.topk import deepest, limit_per_query, rank_hits, with_rows
from lodestone.session import cut_lineage

COVERAGE = ("local", "coverage")
DEFAULT_ALPHA = 0.5

_rerankers: dict[tuple[str, str], Callable[[list[str], list[str]], np.ndarray]] = {}


def normalize_queries(requests: DataFrame) -> DataFrame:
    """Resolve aliases and defaults of a table of search requests.

    ``search_text`` stands in for an empty ``query_text``; ``top_k`` 0 or null becomes 10 and
    any other value passes; metadata is included unless refused; documents and embeddings only
    on request. ``rerank`` may be ``true``/``false`` or a JSON object with ``enabled``,
    ``provider`` and ``model``.
    """

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in requests.columns else F.lit(None).cast(kind)

    rerank = given("rerank", "string")
    is_object = F.startswith(F.ltrim(rerank), F.lit("{"))
    enabled = F.when(is_object, F.get_json_object(rerank, "$.enabled")).otherwise(rerank)
    on = F.coalesce(enabled.try_cast("boolean"), F.lit(False))

    def option(name: str, default: str) -> Column:
        asked = F.when(is_object, F.nullif(F.get_json_object(rerank, f"$.{name}"), F.lit("")))
        return F.when(on, F.coalesce(asked, F.lit(default)))

    top_k = given("top_k", "int")
    return requests.withColumns(
        {
            "query_text": F.coalesce(
                F.nullif(given("query_text", "string"), F.lit("")), given("search_text", "string")
            ),
            "top_k": F.when(top_k.isNull() | (top_k == 0), F.lit(DEFAULT_TOP_K)).otherwise(top_k),
            "include_metadata": F.coalesce(given("include_metadata", "boolean"), F.lit(True)),
            "include_documents": F.coalesce(given("include_documents", "boolean"), F.lit(False)),
            "include_embeddings": F.coalesce(given("include_embeddings", "boolean"), F.lit(False)),
            "rerank_enabled": on,
            "rerank_provider": option("provider", COVERAGE[0]),
            "rerank_model": option("model", COVERAGE[1]),
        }
    ).drop("search_text", "rerank")


def text_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = DEFAULT_TOP_K,
    metric: str = "cosine",
    provider: str = HASHING[0],
    model: str = HASHING[1],
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Embed ``query_text`` like the corpus was, then search by vector."""
    extra = [c for c in ("top_k",) if c in queries.columns]
    vectors = embed_texts(
        queries.select("query_id", "query_text", *extra), "query_text", "query_vector", provider, model, dim
    )
    return vector_search(vectors.select("query_id", "query_vector", *extra), corpus, k, metric)


def _scaled(score: str, low: str, high: str) -> Column:
    """A score on a scale from 0 to 1; a scale of one point gives 1."""
    spread = F.col(high) - F.col(low)
    return F.when(spread > 0, (F.col(score) - F.col(low)) / spread).otherwise(F.lit(1.0))


def scales_of(union: DataFrame) -> DataFrame:
    """Per query the smallest and largest score of each side: ``d_low, d_high, s_low, s_high``."""
    ends = [f(c).alias(f"{c}_{name}") for c in ("d", "s") for name, f in (("low", F.min), ("high", F.max))]
    return union.groupBy("query_id").agg(*ends)


def weights_of(queries: DataFrame, alpha: float | None) -> DataFrame:
    """``query_id, alpha``: a query's own weight of the dense side, else ``alpha``, else one half."""
    weight = F.lit(DEFAULT_ALPHA if alpha is None else float(alpha))
    own = F.coalesce(F.col("alpha").cast("double"), weight) if "alpha" in queries.columns else weight
    return queries.select("query_id", own.alias("alpha"))


def _fused(d: Column, s: Column) -> Column:
    return F.col("alpha") * d + (F.lit(1.0) - F.col("alpha")) * s


def fuse(
    dense: DataFrame, sparse: DataFrame, k: int, alpha: float | None = None, weights: DataFrame | None = None
) -> DataFrame:
    """``alpha * dense + (1 - alpha) * sparse`` over two lists of hits; a missing side is 0.

    Each list is scaled to 0..1 by itself. ``weights`` (query_id, alpha) gives each query its own; a
    null one takes ``alpha``, and that is one half when not given. For lists of which the other
    side's scores are not known; ``hybrid_search`` knows both.
    """

    def scaled(side: DataFrame, name: str) -> DataFrame:
        w = W.partitionBy("query_id")
        ends = side.withColumns({"__l": F.min("score").over(w), "__h": F.max("score").over(w)})
        return ends.select("query_id", "id", _scaled("score", "__l", "__h").alias(name))

    both = scaled(dense, "d").join(scaled(sparse, "s"), ["query_id", "id"], "full_outer")
    if weights is None:
        weights = both.select("query_id").distinct()
    both = both.join(weights_of(weights, alpha), "query_id", "left")
    score = _fused(F.coalesce("d", F.lit(0.0)), F.coalesce("s", F.lit(0.0)))
    hits = both.select("query_id", "id", F.round(score, 6).alias("score"))
    return rank_hits(hits, k).select("query_id", "rank", "id", "score")


def hybrid_search(
    queries: DataFrame,
    corpus: DataFrame,
    index: SparseIndex,
    k: int = DEFAULT_TOP_K,
    alpha: float | None = None,
    depth: int | None = None,
    metric: str = "cosine",
    provider: str = HASHING[0],
    model: str = HASHING[1],
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """The best documents of the whole corpus by ``alpha * dense + (1 - alpha) * sparse`` of one text.

    Each side names its ``depth`` best documents (4k, at least 100; never fewer than k), and their union is scored on
    both sides; its smallest and largest scores make a query's scale, 0 to 1 per side. A document in
    neither list scores at most the last of each list. While that could still reach a query's k best,
    the query's lists are made four times as deep; the scale stays. So the hits are those of scoring every document.
    ``alpha`` is the weight of the dense side, one half by default; a column ``alpha`` of the queries
    comes first.
    """
    most = deepest(queries, k)
    depth = max(depth or max(4 * most, 100), most)
    extra = [c for c in ("query_text", "sparse_query", "alpha") if c in queries.columns]
    open_ = embed_texts(queries.select("query_id", *extra), "query_text", "query_vector", provider, model, dim)
    open_ = cut_lineage(open_)
    asked = Asked(open_, index)
    weights = weights_of(queries, alpha)
    scales, done = None, None
    while True:
        dense = vector_search(open_.select("query_id", "query_vector"), corpus, depth, metric)
        sparse = rank_hits(asked.best(depth), depth).select("query_id", "rank", "id", "score")
        sparse = sparse.join(open_.select("query_id"), "query_id", "left_semi")
        dense, sparse = cut_lineage(dense), cut_lineage(sparse)
        union = cut_lineage(score_union(dense, sparse, open_, corpus, asked, metric))
        if scales is None:
            scales = cut_lineage(scales_of(union))
        scored = union.join(scales, "query_id").join(weights, "query_id")
        lexical = _scaled("s", "s_low", "s_high")
        score = F.round(_fused(F.coalesce(_scaled("d", "d_low", "d_high"), F.lit(0.0)), lexical), 6)
        hits = scored.select("query_id", "id", score.alias("score"))
        ranked = cut_lineage(rank_hits(hits, most).select("query_id", "rank", "id", "score"))
        # what a document in neither list can have at most; a list that is not full has left none out
        outside = open_.select("query_id")
        for side, name in ((dense, "d"), (sparse, "s")):
            last = side.where(F.col("rank") == depth).select("query_id", F.col("score").alias(name))
            outside = outside.join(last, "query_id", "left")
        outside = outside.where("d IS NOT NULL OR s IS NOT NULL").fillna(0.0, ["s"])
        # a document without a vector has 0 there, be the list's last one below that
        best = F.round(_fused(F.greatest(_scaled("d", "d_low", "d_high"), F.lit(0.0)), lexical), 6)
        outside = outside.join(scales, "query_id").join(weights, "query_id").select("query_id", best.alias("most"))
        kth = ranked.where(F.col("rank") == most).select("query_id", "score")
        reach = outside.join(kth, "query_id", "left").where("score IS NULL OR most >= score").select("query_id")
        reach = cut_lineage(reach)
        settled = ranked.join(reach, "query_id", "left_anti")
        done = settled if done is None else done.unionByName(settled)
        if reach.isEmpty():
            return limit_per_query(done, queries, k)
        open_ = cut_lineage(open_.join(reach, "query_id", "left_semi"))
        depth *= 4


def score_union(dense: DataFrame, sparse: DataFrame, queries: DataFrame, corpus: DataFrame, asked: Asked, metric: str) -> DataFrame:
    """``query_id, id, d, s``: both lists' documents with both scores.

    Without a common term ``s`` is 0, without a vector that can match ``d`` is null.
    """
    both = dense.select("query_id", "id", F.col("score").alias("d")).join(
        sparse.select("query_id", "id", F.col("score").alias("s")), ["query_id", "id"], "full_outer"
    )
    both = cut_lineage(both)
    no_dense = with_rows(both.where("d IS NULL").select("query_id", "id"), corpus.select("id", "values"), how="left")
    no_dense = no_dense.join(queries.select("query_id", "query_vector"), "query_id")
    vector = pair_score(metric, F.col("values"), F.col("query_vector"))
    fits = usable(F.col("values"), F.size("query_vector"))
    no_dense = no_dense.select("query_id", "id", F.when(fits, vector).alias("__d"))
    no_sparse = asked.of_pairs(both.where("s IS NULL").select("query_id", "id")).withColumnRenamed("score", "__s")
    rows = both.join(no_dense, ["query_id", "id"], "left").join(no_sparse, ["query_id", "id"], "left")
    return rows.select("query_id", "id", F.coalesce("d", "__d").alias("d"), F.coalesce("s", "__s", F.lit(0.0)).alias("s"))


def register_reranker(
    provider: str, model: str, fn: Callable[[list[str], list[str]], np.ndarray]
) -> None:
    """Make ``fn`` (queries, texts -> scores) the pair scorer of provider/model."""
    _rerankers[(provider, model)] = fn


def _coverage(query: Column, text: Column) -> Column:
    wanted = F.array_distinct(tokens(query))
    shared = F.size(F.array_intersect(wanted, tokens(text)))
    return F.when(F.size(wanted) > 0, F.round(shared / F.size(wanted), 6)).otherwise(F.lit(0.0))


def rerank(
    hits: DataFrame,
    queries: DataFrame,
    texts: DataFrame,
    k: int = DEFAULT_TOP_K,
    provider: str = COVERAGE[0],
    model: str = COVERAGE[1],
) -> DataFrame:
    """Order hits by a pair score of query and text, then by their first score, then by id.

    The built-in scorer is the share of the query's distinct tokens found in the text.
    """
    if (provider, model) == COVERAGE:
        pair = _coverage(F.col("query_text"), F.col("text"))
    elif (provider, model) in _rerankers:
        fn = _rerankers[(provider, model)]

        @F.arrow_udf("double")
        def score_pairs(query: pa.Array, text: pa.Array) -> pa.Array:
            return pa.array(np.asarray(fn(query.to_pylist(), text.to_pylist()), dtype=np.float64))

        pair = F.round(score_pairs("query_text", "text"), 6)
    else:
        raise ValueError(f"no reranker registered for {provider}/{model}")
    paired = (
        with_rows(hits, texts.select("id", "text"))
        .join(queries.select("query_id", "query_text"), "query_id")
        .select("query_id", "id", F.col("score").alias("first_score"), pair.alias("score"))
    )
    order = [F.col("score").desc(), F.col("first_score").desc(), F.col("id").asc()]
    return rank_hits(paired, k, order=order).select("query_id", "rank", "id", "score", "first_score")


def result_projection(
    hits: DataFrame,
    records: DataFrame,
    metadata: str | None = "metadata",
    include_metadata: bool | None = None,
    include_embeddings: bool = False,
    include_documents: bool = False,
) -> DataFrame:
    """Attach the wide columns asked for to ranked hits.

    The ranking runs without them; columns not asked for are never read. Metadata comes by
    default, embeddings and documents (``doc_kind``, ``doc_value``) only on request.
    """
    wanted = []
    if include_metadata in (None, True) and metadata:
        wanted.append(metadata)
    if include_embeddings:
        wanted.append(F.col("values").alias("embedding"))
    if include_documents:
        wanted += ["doc_kind", "doc_value"]
    return with_rows(hits, records.select("id", *wanted), how="left") if wanted else hits


def search_all_collections(
    queries: DataFrame,
    collections: Mapping[str, DataFrame],
    k: int = DEFAULT_TOP_K,
    scope: str = "all",
    metric: str = "cosine",
) -> DataFrame:
    """Top-k over one collection or over all of them, each hit tagged with its collection.

    A collection that holds vectors, but none as long as the queries', is an error.
    """
    if scope != "all" and scope not in collections:
        raise ValueError(f"unknown collection {scope!r}")
    names = sorted(collections) if scope == "all" else [scope]
    asked = queries.where(F.size("query_vector") > 0).select(F.size("query_vector").alias("dim")).first()
    for n in names if asked else []:
        held = collections[n].where(F.size("values") > 0)
        if held.where(F.size("values") == asked["dim"]).isEmpty() and not held.isEmpty():
            raise ValueError(f"collection {n!r} has no vectors of {asked['dim']} values")
    parts = [
        vector_search(queries, collections[n], k, metric).withColumn("collection", F.lit(n)) for n in names
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    order = [F.col("score").desc(), F.col("collection").asc(), F.col("id").asc()]
    ranked = rank_hits(union.drop("rank"), k, order=order)
    return ranked.select("query_id", "rank", "collection", "id", "score")
