"""Search against brute force, and the properties that tie the searches together."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.functions.ids import int_id, string_id
from lodestone.functions.vectors import score_block
from lodestone.operators import ann, dense
from lodestone.operators.dense import grid_scan, vector_search
from lodestone.operators.embed import embed_texts, register_embedder
from lodestone.operators.filters import Filter, filter_advanced, filter_equality
from lodestone.operators.search import (
    fuse,
    hybrid_search,
    normalize_queries,
    register_reranker,
    rerank,
    result_projection,
    search_all_collections,
    text_search,
)
from lodestone.operators.sparse import SparseIndex, build_sparse_index, sparse_search
from lodestone.operators.topk import rank_hits
from lodestone.plans import search as plans


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return plans.vectors(spark, sf).select("id", "values")


@pytest.fixture(scope="module")
def queries(spark, sf):
    return plans.label_queries(spark, sf)


def brute(queries, corpus, k, metric):
    """Top-k by numpy over collected tables."""
    q = sorted((r["query_id"], r["query_vector"]) for r in queries.collect())
    c = sorted((r["id"], r["values"]) for r in corpus.collect())
    scores = score_block(metric, np.array([v for _, v in c]), np.array([v for _, v in q]))
    out = []
    for j, (query_id, _) in enumerate(q):
        order = sorted(range(len(c)), key=lambda i: (-scores[i, j], c[i][0]))[:k]
        out += [(query_id, r + 1, c[i][0], float(scores[i, j])) for r, i in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("strategy", ["broadcast", "grid"])
def test_exact_search(queries, vectors, metric, strategy):
    assert rows(vector_search(queries, vectors, 7, metric, strategy)) == brute(queries, vectors, 7, metric)


def test_small_blocks_and_batches_change_nothing(spark, queries, vectors, monkeypatch):
    want = rows(vector_search(queries, vectors, 5))
    hits = grid_scan(queries, vectors, 5, "cosine", 64, block_rows=37, block_queries=3)
    assert rows(rank_hits(hits, 5).select("query_id", "rank", "id", "score")) == want
    assert rows(vector_search(queries, vectors, 5, query_rows=4)) == want  # too many queries: the grid
    monkeypatch.setattr(dense, "BLOCK_CELLS", 64)
    monkeypatch.setattr(dense, "MERGE_ROWS", 1)
    assert rows(vector_search(queries, vectors, 5)) == want


def test_strategy_errors(queries, vectors):
    with pytest.raises(ValueError):
        vector_search(queries, vectors, 5, "hamming")
    with pytest.raises(ValueError):
        vector_search(queries, vectors, 5, strategy="broadcast", query_rows=2)
    assert vector_search(queries.where("false"), vectors).count() == 0


def test_copies_tie_by_id(spark):
    """Two thirds of the corpus are copies of one vector: ids decide, in every plan."""
    corpus = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("values")
    ).repartition(7)
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, query_vector array<double>")
    want = [1, 2, 4, 5, 7]
    for strategy in ("broadcast", "grid"):
        hits = vector_search(query, corpus, 5, strategy=strategy).orderBy("rank").collect()
        assert [r["id"] for r in hits] == want


def test_other_dimensions_and_nulls_do_not_match(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 0.0])], "id int, values array<double>")
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, query_vector array<double>")
    for strategy in ("broadcast", "grid"):
        assert rows(vector_search(query, corpus, 5, strategy=strategy), "id", "score") == [(1, 1.0), (4, 0.0)]


def test_typed_ids_survive(spark, queries, vectors):
    typed = vectors.withColumn("id", F.when(F.col("id") % 2 == 0, int_id(F.col("id"))).otherwise(string_id(F.col("id").cast("string"))))
    for strategy in ("broadcast", "grid"):
        hits = vector_search(queries, typed, 3, strategy=strategy)
        kinds = {(r["id"]["kind"], r["id"]["i"] is not None) for r in hits.collect()}
        assert kinds == {("int", True), ("str", False)}


def test_top_k_per_query(spark, queries, vectors):
    own = queries.withColumn("top_k", (F.col("query_id") % 3 + 1).cast("int"))
    counts = vector_search(own, vectors, 10).groupBy("query_id").count()
    assert all(r["count"] == r["query_id"] % 3 + 1 for r in counts.collect())


def test_own_depth_and_no_queries(spark, queries, vectors):
    asked = queries.withColumn("top_k", F.when(F.col("query_id") == 0, 3).when(F.col("query_id") == 1, 25).when(F.col("query_id") == 2, 0))
    centroids = ann.train_centroids(vectors, 6)
    index = ann.ann_build(vectors, centroids)
    for hits in (
        vector_search(asked, vectors, 10),
        ann.ann_search(asked, index, centroids, 10, nprobe=64),
        ann.rerank_depth_search(asked, index, 10),
    ):
        found = {r.query_id: r["count"] for r in hits.groupBy("query_id").count().collect()}
        assert (found[0], found[1], found[2], found[3]) == (3, 25, 10, 10)
    none = queries.where("false")
    assert vector_search(none, vectors).count() == ann.ann_search(none, index, centroids).count() == 0


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_vectors_with_bad_elements_match_nothing(spark, queries, vectors, metric):
    bad = [(9_000_001, [float("nan")] * 64), (9_000_002, [None] * 64), (9_000_003, [float("inf")] + [0.0] * 63)]
    more = vectors.unionAll(spark.createDataFrame(bad, "id long, values array<float>"))
    assert rows(vector_search(queries, more, 10, metric)) == rows(vector_search(queries, vectors, 10, metric))


def test_ann_with_all_cells_is_exact(queries, vectors):
    centroids = ann.train_centroids(vectors, 6)
    index = ann.ann_build(vectors, centroids)
    want = rows(vector_search(queries, vectors, 8))
    assert rows(ann.ann_search(queries, index, centroids, 8, nprobe=6)) == want
    assert rows(ann.ann_search(queries, index, centroids, 8, nprobe=6, block_rows=20, block_queries=2)) == want


def test_ann_reads_probed_cells_only(spark, queries, vectors, folder):
    centroids = ann.mean_centroids(plans.vectors(spark, "/root/testdata/sf0.001"), "label")
    index = ann.write_index(ann.ann_build(vectors, centroids), folder + "/index")
    one = queries.where("query_id = 3")
    hits = ann.ann_search(one, index, centroids, 5, nprobe=2)
    plan = hits._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(top" in plan or "PartitionFilters: [top" in plan
    exact = {r["id"] for r in vector_search(one, vectors, 5).collect()}
    assert len(exact & {r["id"] for r in hits.collect()}) >= 1


def test_hot_cell_is_cut(spark):
    """All vectors in one cell: blocks stay bounded and the result exact."""
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(500)]
    corpus = spark.createDataFrame(data, "id int, values array<double>")
    centroids = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0])], "cell int, centroid array<double>")
    query = spark.createDataFrame([(q, data[q][1]) for q in range(9)], "query_id int, query_vector array<double>")
    hits = ann.ann_search(query, ann.ann_build(corpus, centroids), centroids, 4, 1, block_rows=50, block_queries=2)
    assert rows(hits) == rows(vector_search(query, corpus, 4))


def test_depth_of_everything_is_exact(queries, vectors):
    centroids = ann.mean_centroids(vectors.withColumn("one", F.lit(0)), "one")
    index = ann.ann_build(vectors, centroids)
    want = rows(vector_search(queries, vectors, 5))
    assert rows(ann.rerank_depth_search(queries, index, 5, depth=500)) == want


@pytest.fixture(scope="module")
def docs(spark):
    data = [(1, "the red fox"), (2, "the red red dog"), (3, "a blue fish"), (4, ""), (5, "the fox and the dog")]
    return spark.createDataFrame(data, "id int, text string")


@pytest.fixture(scope="module")
def asks(spark):
    return spark.createDataFrame([(1, "red fox"), (2, "fish"), (3, "nothing here")], "query_id int, query_text string")


def test_bm25_by_hand(docs, asks):
    texts = {r["id"]: r["text"].split() for r in docs.collect()}
    n, av = len(texts), sum(map(len, texts.values())) / len(texts)
    want = []
    for q in asks.collect():
        scored = []
        for i, words in texts.items():
            s = 0.0
            for term in set(q["query_text"].split()):
                df = sum(term in w for w in texts.values())
                tf = words.count(term)
                if tf:
                    s += np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / av))
            if s:
                scored.append((-round(s, 6), i))
        want += [(q["query_id"], r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:3])]
    index = build_sparse_index(docs)
    assert rows(sparse_search(asks, index, 3)) == sorted(want, key=repr)


def test_shuffled_and_stored_index_give_the_same(docs, asks, folder, monkeypatch):
    from lodestone.operators import sparse

    want = rows(sparse_search(asks, build_sparse_index(docs), 3))
    monkeypatch.setattr(sparse, "HOT_ROWS", 1)  # every term counts as hot
    assert rows(sparse_search(asks, build_sparse_index(docs), 3, term_rows=0)) == want
    stored = build_sparse_index(docs).write(folder + "/sparse")
    assert rows(sparse_search(asks, stored, 3)) == want
    assert rows(sparse_search(asks, SparseIndex.read(docs.sparkSession, folder + "/sparse"), 3, term_rows=0)) == want


def test_sparse_query_wins_over_text(asks, docs):
    only = asks.withColumn("sparse_query", F.when(F.col("query_id") == 3, "dog"))
    hits = sparse_search(only, build_sparse_index(docs), 5)
    assert rows(hits.where("query_id = 3"), "id") == [(2,), (5,)]


def test_hybrid_ends(docs, asks):
    corpus, index = embed_texts(docs), build_sparse_index(docs)
    dense_ids = rows(text_search(asks, corpus, 4), "query_id", "rank", "id")
    assert rows(hybrid_search(asks, corpus, index, 4, alpha=1.0), "query_id", "rank", "id") == dense_ids
    sparse_hits = sparse_search(asks, index, 4).where("query_id < 3")
    hybrid = hybrid_search(asks, corpus, index, 4, alpha=0.0).where("query_id < 3 AND score > 0")
    want = {(r["query_id"], r["id"]) for r in sparse_hits.collect()}
    best = {(r["query_id"], r["id"]) for r in sparse_hits.where("rank = 1").collect()}
    got = {(r["query_id"], r["id"]) for r in hybrid.collect()}
    assert got <= want and best <= got


def test_fuse_default_weight(spark):
    dense_hits = spark.createDataFrame([(1, 1, "a", 0.9), (1, 2, "b", 0.1)], "query_id int, rank int, id string, score double")
    sparse_hits = spark.createDataFrame([(1, 1, "b", 3.0)], "query_id int, rank int, id string, score double")
    assert rows(fuse(dense_hits, sparse_hits, 5)) == [(1, 1, "a", 0.5), (1, 2, "b", 0.5)]


def test_fuse_weight_per_query(spark):
    dense_hits = spark.createDataFrame([(q, 1, "a", 0.9) for q in (1, 2)], "query_id int, rank int, id string, score double")
    weights = spark.createDataFrame([(1, 0.25), (2, None)], "query_id int, alpha double")
    fused = fuse(dense_hits, dense_hits.limit(0), 5, weights=weights)
    assert rows(fused, "query_id", "score") == [(1, 0.25), (2, 0.5)]


def test_more_hits_than_spark_cuts_early(spark):
    hits = spark.range(3000).select(F.lit(1).alias("query_id"), "id", (F.col("id") % 10).cast("double").alias("score"))
    want = sorted(range(3000), key=lambda i: (-(i % 10), i))[:1500]
    assert [r["id"] for r in rank_hits(hits, 1500).orderBy("rank").collect()] == want


def test_registered_embedder_runs_per_distinct_text(spark):
    register_embedder("test", "len", 2, lambda texts: np.array([[len(t), 1.0] for t in texts]))
    df = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, None), (4, "b")], "id int, text string")
    got = rows(embed_texts(df, provider="test", model="len"), "id", "values")
    assert got == [(1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [0.0, 1.0]), (4, [1.0, 1.0])]
    with pytest.raises(ValueError):
        embed_texts(df, provider="test", model="none")


def test_embedder_runs_once(spark):
    df = embed_texts(spark.createDataFrame([(1, "a b"), (2, "c")], "id int, text string"))
    plan = df.where(F.size("values") == 64)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_rerank(spark, docs):
    asks = spark.createDataFrame([(1, "dog fox")], "query_id int, query_text string")
    hits = spark.createDataFrame([(1, 1, 1, 0.9), (1, 2, 2, 0.8), (1, 3, 5, 0.1)], "query_id int, rank int, id int, score double")
    assert [r["id"] for r in rerank(hits, asks, docs).orderBy("rank").collect()] == [5, 1, 2]
    register_reranker("test", "shortest", lambda q, t: -np.array([len(x) for x in t], dtype=float))
    assert [r["id"] for r in rerank(hits, asks, docs, 2, "test", "shortest").orderBy("rank").collect()] == [1, 2]
    with pytest.raises(ValueError):
        rerank(hits, asks, docs, provider="x")


def test_normalize(spark):
    data = [
        (1, "", "rare zebra quokka", 0, None, None),
        (2, "hello", "ignored", 5, False, "true"),
        (3, None, "a", -3, True, '{"enabled": true, "model": "m2"}'),
        (4, "x", None, None, None, '{"enabled": false, "model": "m2"}'),
    ]
    schema = "query_id int, query_text string, search_text string, top_k int, include_metadata boolean, rerank string"
    got = {r["query_id"]: r for r in normalize_queries(spark.createDataFrame(data, schema)).collect()}
    assert [got[i]["query_text"] for i in (1, 2, 3, 4)] == ["rare zebra quokka", "hello", "a", "x"]
    assert [got[i]["top_k"] for i in (1, 2, 3, 4)] == [10, 5, -3, 10]
    assert [got[i]["include_metadata"] for i in (1, 2, 3, 4)] == [True, False, True, True]
    assert [got[i]["rerank_enabled"] for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert [got[i]["rerank_model"] for i in (1, 2, 3, 4)] == [None, "coverage", "m2", None]
    assert not got[1]["include_documents"] and not got[1]["include_embeddings"]


def test_projection(spark, queries, vectors):
    records = vectors.withColumns({"metadata": F.create_map(F.lit("a"), F.lit("b")), "doc_kind": F.lit("text"), "doc_value": F.lit("v")})
    hits = vector_search(queries, vectors, 2)
    assert result_projection(hits, records, include_metadata=False).columns == hits.columns
    assert "metadata" in result_projection(hits, records).columns
    full = result_projection(hits, records, include_embeddings=True, include_documents=True)
    assert {"metadata", "embedding", "doc_kind", "doc_value"} <= set(full.columns)
    assert full.count() == hits.count()


def test_all_collections(spark, queries, vectors):
    halves = {"even": vectors.where("id % 2 = 0"), "odd": vectors.where("id % 2 = 1")}
    everything = rows(search_all_collections(queries, halves, 6), "query_id", "rank", "id", "score")
    assert everything == rows(vector_search(queries, vectors, 6))
    alone = search_all_collections(queries, halves, 6, scope="odd")
    assert {r["collection"] for r in alone.collect()} == {"odd"}
    with pytest.raises(ValueError):
        search_all_collections(queries, halves, 6, scope="none")


@pytest.fixture(scope="module")
def records(spark):
    data = [(1, "en", 5, '{"tag": "x", "n": 1}'), (2, "fr", None, '{"tag": "xy"}'), (3, None, 9, "{}")]
    df = spark.createDataFrame(data, "id int, lang string, size int, m string")
    return df.select("id", "lang", "size", F.parse_json("m").alias("metadata"))


@pytest.mark.parametrize(
    "f, ids",
    [
        (Filter("lang", "eq", "en"), [1]),
        (Filter("lang", "ne", "en"), [2, 3]),
        (Filter("size", "gt", 5), [3]),
        (Filter("size", "gte", 5), [1, 3]),
        (Filter("size", "lt", 9), [1]),
        (Filter("size", "lte", 9), [1, 3]),
        (Filter("lang", "in", values=("en", "fr")), [1, 2]),
        (Filter("lang", "in", values=()), []),
        (Filter("lang", "not_in", values=("en",)), [2, 3]),
        (Filter("size", "between", values=(1, 6)), [1]),
        (Filter("lang", "exists"), [1, 2]),
        (Filter("tag", "not_exists"), [3]),
        (Filter("tag", "prefix", "x"), [1, 2]),
        (Filter("tag", "contains", "y"), [2]),
        (Filter("n", "eq", "1"), [1]),
        (Filter("n", "eq", 1), [1]),
        (Filter("lang", "prefix", "e_"), []),
    ],
)
def test_filter_ops(records, f, ids):
    assert rows(filter_advanced(records, [f]), "id") == [(i,) for i in ids]


def test_filters_combine_and_fail_early(records):
    assert rows(filter_equality(records, {"lang": "en", "tag": "x"}), "id") == [(1,)]
    assert rows(filter_equality(records, {"size": "5"}), "id") == [(1,)]
    assert rows(filter_equality(records, {"missing": "1"}), "id") == []
    assert filter_advanced(records, []).count() == 3
    for bad in (Filter("a", "like", "x"), Filter("a", "between", values=(1,)), Filter("a", "eq")):
        with pytest.raises(ValueError):
            filter_advanced(records, [bad])
