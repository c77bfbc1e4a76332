"""The cell index: training on all rows, placing, storing, and the search with both knobs."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.functions.vectors import score_block
from lodestone.operators import ann
from lodestone.operators.dense import vector_search
from lodestone.plans import search as plans


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return plans.vectors(spark, sf).select("id", "values").repartition(3).cache()


@pytest.fixture(scope="module")
def queries(spark, sf):
    return plans.label_queries(spark, sf).cache()


def blobs(spark, n=600, groups=5, dim=4, seed=3):
    """Vectors around well separated directions."""
    rng = np.random.default_rng(seed)
    middles = np.eye(max(groups, dim))[:groups, :dim] * 10 + rng.normal(size=(groups, dim))
    data = [(i, [float(x) for x in middles[i % groups] + rng.normal(scale=0.05, size=dim)]) for i in range(n)]
    return spark.createDataFrame(data, "id int, values array<double>").repartition(4)


def test_training_reads_every_row(spark):
    """Each pass sums all rows: the centroids are the mean directions, which no sample gives to 6 digits."""
    rng = np.random.default_rng(0)
    data = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(500)]
    corpus = spark.createDataFrame(data, "id int, values array<double>").repartition(4)
    [one] = ann.train_centroids(corpus, 1).collect()
    unit = np.array([v for _, v in data])
    mean = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).sum(0)
    assert one["centroid"] == pytest.approx((mean / np.linalg.norm(mean)).tolist(), abs=2e-6)


def test_passes_find_separate_groups(spark):
    corpus = blobs(spark)
    found = ann.train_centroids(corpus, 12)
    assert found.columns == ["cell", "top", "centroid"]
    data = np.array([r["values"] for r in corpus.collect()])
    score = score_block("cosine", data, np.array([r["centroid"] for r in found.collect()]))
    assert score.max(axis=1).min() > 0.99


def test_copies_give_one_seed(spark):
    same = spark.range(400).select(F.col("id"), F.array(F.lit(1.0), F.lit(2.0)).alias("values"))
    assert ann.train_centroids(same, 9).count() == 1
    mixed = same.unionByName(blobs(spark, 40, 2, 2).withColumn("id", F.col("id") + 1_000))
    assert 2 <= ann.train_centroids(mixed, 6).count() <= 6


def test_default_number_of_cells_has_no_limit(spark, monkeypatch):
    monkeypatch.setattr(ann, "CENTROID_BYTES", 8 * 4 * 12)  # twelve centroids go to every task
    corpus = blobs(spark, 900)
    found = ann.train_centroids(corpus, 40)
    assert 20 <= found.count() <= 80 and found.select("top").distinct().count() <= 12
    assert found.select("cell").distinct().count() == found.count()


@pytest.mark.parametrize("route_rows", [50, 200_000])
@pytest.mark.parametrize("depth", [0, 600])
def test_two_levels(spark, monkeypatch, folder, route_rows, depth):
    """Vectors reach cells below their own top cell, and all cells together give the exact result."""
    monkeypatch.setattr(ann, "CENTROID_BYTES", 8 * 4 * 12)
    monkeypatch.setattr(ann, "ROUTE_ROWS", route_rows)
    corpus = blobs(spark)
    asked = corpus.where("id < 5").select(F.col("id").alias("query_id"), F.col("values").alias("query_vector"))
    centroids = ann.train_centroids(corpus, 30).cache()
    index = ann.write_index(ann.ann_build(corpus, centroids), folder + "/index")
    assert index.count() == corpus.count() and index.where("cell = -1").isEmpty()
    placed = index.select("cell", F.col("top").alias("folder")).distinct().join(centroids, "cell")
    assert placed.where("folder <> top").isEmpty()
    hits = ann.ann_search(asked, index, centroids, 7, nprobe=centroids.count(), depth=depth)
    assert rows(hits) == rows(vector_search(asked, corpus, 7))


def test_bad_vectors_are_set_apart(spark, vectors, queries, folder):
    bad = [(9_001, None), (9_002, [1.0]), (9_003, [float("nan")] * 64), (9_004, [None] * 64), (9_005, [])]
    more = vectors.unionByName(spark.createDataFrame(bad, "id long, values array<float>"))
    centroids = ann.train_centroids(more, 5)
    index = ann.write_index(ann.ann_build(more, centroids), folder + "/index")
    apart = index.where("cell = -1")
    assert rows(apart, "id") == [(i,) for i, _ in bad] and apart.where("codes IS NOT NULL").isEmpty()
    want = rows(vector_search(queries, vectors, 6))
    assert rows(ann.ann_search(queries, index, centroids, 6, nprobe=99)) == want
    assert rows(ann.ann_search(queries, index, centroids, 6, nprobe=99, depth=500)) == want


def brute_cells(queries, vectors, centroids, k, nprobe, depth, metric):
    cells = sorted((r["cell"], r["centroid"]) for r in centroids.collect())
    middles = np.array([c for _, c in cells])
    data = sorted((r["id"], r["values"]) for r in vectors.collect())
    matrix = np.array([v for _, v in data], dtype=np.float64)
    home = score_block("cosine", matrix, middles).argmax(axis=1)
    peak = np.abs(matrix).max(1, keepdims=True)
    codes = np.floor(127 * matrix / peak + 0.5) * (peak / 127)
    out = []
    for r in queries.collect():
        q = np.array([r["query_vector"]])
        probed = np.argsort(-score_block("cosine", middles, q)[:, 0], kind="stable")[:nprobe]
        rows_in = [i for i in range(len(data)) if home[i] in probed]
        if depth:
            coarse = score_block(metric, codes, q)[:, 0]
            rows_in = sorted(rows_in, key=lambda i: (-coarse[i], data[i][0]))[:depth]
        exact = score_block(metric, matrix, q)[:, 0]
        best = sorted(rows_in, key=lambda i: (-exact[i], data[i][0]))[:k]
        out += [(r["query_id"], n + 1, data[i][0], float(exact[i])) for n, i in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("metric, nprobe, depth", [("cosine", 1, 0), ("cosine", 3, 30), ("dot", 2, 12), ("l2", 99, 9), ("l2", 2, 0)])
def test_both_knobs(queries, vectors, metric, nprobe, depth):
    centroids = ann.train_centroids(vectors, 6, passes=2).cache()
    index = ann.ann_build(vectors, centroids).cache()
    want = brute_cells(queries, vectors, centroids, 5, nprobe, depth, metric)
    assert rows(ann.ann_search(queries, index, centroids, 5, nprobe, depth, metric)) == want
    # a batch of queries beyond the budget takes the grid
    assert rows(ann.ann_search(queries, index, centroids, 5, nprobe, depth, metric, query_rows=2, block_rows=40, block_queries=3)) == want


def test_search_leaves_vectors_in_place(spark, queries, vectors, folder):
    centroids = ann.train_centroids(vectors, 6)
    index = ann.write_index(ann.ann_build(vectors, centroids), folder + "/index")
    plan = ann.ann_search(queries, index, centroids, 5, nprobe=2)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert exchanges and not any("values" in line for line in exchanges)
    assert "PartitionFilters: [top" in plan and "codes" not in plan
    # with a depth the scan that all probed rows go through reads codes, not vectors
    seen = []
    scan, best = ann.scan_cells, ann.rank_hits
    try:
        ann.scan_cells = lambda head, kind, some, *rest: seen.append(some) or scan(head, kind, some, *rest)
        ann.ann_search(queries, index, centroids, 5, nprobe=2, depth=20)
    finally:
        ann.scan_cells = scan
    codes = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "codes:array<tinyint>" in codes and "values:array" not in codes and best is ann.rank_hits


def test_large_top_cells_are_cut_into_files(spark, folder, monkeypatch):
    monkeypatch.setattr(ann, "FILE_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for large partitions
    corpus = blobs(spark, 500, 1)
    index = ann.write_index(ann.ann_build(corpus, ann.train_centroids(corpus, 1)), folder + "/index")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.count() == 500 and 2 <= len(index.inputFiles()) <= 5


def test_queries_of_two_lengths_are_refused(spark, vectors, queries):
    odd = queries.unionByName(spark.createDataFrame([(77, [1.0])], "query_id int, query_vector array<double>"))
    with pytest.raises(ValueError, match="different lengths"):
        vector_search(odd, vectors)
    with pytest.raises(ValueError, match="different lengths"):
        vector_search(odd, vectors, query_rows=1)
    centroids = ann.train_centroids(vectors, 3)
    with pytest.raises(ValueError, match="different lengths"):
        ann.ann_search(odd, ann.ann_build(vectors, centroids), centroids)


def test_no_vectors_no_index(vectors):
    with pytest.raises(ValueError, match="no vectors"):
        ann.train_centroids(vectors.limit(0))
    centroids = ann.train_centroids(vectors, 2)
    assert ann.ann_build(vectors.limit(0), centroids).count() == 0


def test_l2_keeps_the_digits_of_near_vectors(spark):
    corpus = spark.createDataFrame([(1, [1e6, 1e6]), (2, [1e6, 1e6 + 0.001])], "id int, values array<double>")
    query = spark.createDataFrame([(0, [1e6, 1e6])], "query_id int, query_vector array<double>")
    assert rows(vector_search(query, corpus, 2, "l2"), "id", "score") == [(1, 0.0), (2, -0.001)]
