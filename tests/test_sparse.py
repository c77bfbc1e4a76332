"""BM25 over blocks of documents, and hybrid search, against scoring everything."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.functions.ids import int_id
from lodestone.functions.vectors import score_block
from lodestone.operators import sparse
from lodestone.operators.embed import embed_texts
from lodestone.operators.search import hybrid_search
from lodestone.operators.sparse import Asked, SparseIndex, build_sparse_index, pack, sparse_search, unpack

WORDS = [f"w{i}" for i in range(40)]


def texts(n=120, seed=2):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, len(WORDS) + 1)
    some = [" ".join(rng.choice(WORDS, size=rng.integers(1, 30), p=share / share.sum())) for _ in range(n)]
    return some + some[:10] + ["", "unseen"]  # copies tie, and two match nothing


ASKS = [(1, "w0 w1"), (2, "w39 w38 w37 w2"), (3, "w5 w5 nothing"), (4, "nothing at all"), (5, " ".join(WORDS)), (6, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts())), "id int, text string").repartition(3).cache()


@pytest.fixture(scope="module")
def asks(spark):
    return spark.createDataFrame(ASKS, "query_id int, query_text string").cache()


def bm25(corpus, ask):
    """Unrounded scores of the documents that share a term."""
    words = [t.split() for t in corpus]
    n, mean, out = len(words), sum(map(len, words)) / len(words), {}
    for i, w in enumerate(words):
        for term in set(ask.split()):
            tf = w.count(term)
            if tf:
                df = sum(term in x for x in words)
                idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
                out[i] = out.get(i, 0.0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
    return out


def brute(k):
    out = []
    for query, ask in ASKS:
        best = sorted((-round(s, 6), i) for i, s in bm25(texts(), ask).items())[:k]
        out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_docs, k", [(1, 5), (7, 5), (4_096, 12), (7, 500)])
def test_blocks_change_nothing(docs, asks, monkeypatch, block_docs, k):
    monkeypatch.setattr(sparse, "BLOCK_DOCS", block_docs)
    assert rows(sparse_search(asks, build_sparse_index(docs), k)) == brute(k)


def test_blocks_end_at_many_postings_and_cross_batches(spark, docs, asks, monkeypatch):
    monkeypatch.setattr(sparse, "BLOCK_POSTINGS", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        index = build_sparse_index(docs)
        assert index.packed().count() > 10
        assert rows(sparse_search(asks, index, 6)) == brute(6)
        assert rows(unpack(pack(index.by_document)), "term", "id", "dl", "tf") == rows(index.postings, "term", "id", "dl", "tf")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stored_shuffled_and_disordered_indexes(spark, docs, asks, folder):
    index, want = build_sparse_index(docs), brute(5)
    stored = index.write(folder + "/sparse")
    assert rows(stored.term_stats(), "term", "df", "cf") == rows(index.term_stats(), "term", "df", "cf")
    loose = SparseIndex(index.postings.repartition(5, "term"), index.lengths)
    for some in (stored, SparseIndex.read(spark, folder + "/sparse"), loose):
        assert rows(sparse_search(asks, some, 5)) == want
        assert rows(sparse_search(asks, some, 5, term_rows=0)) == want


def test_typed_ids(docs, asks):
    typed = docs.withColumn("id", int_id(F.col("id")))
    got = sparse_search(asks, build_sparse_index(typed), 5).withColumn("id", F.col("id.i").cast("int"))
    assert rows(got, "query_id", "rank", "id", "score") == brute(5)


def test_scores_of_given_pairs(spark, docs, asks):
    pairs = [(q, i) for q, _ in ASKS for i in range(0, 132, 9)]
    asked = Asked(asks, build_sparse_index(docs))
    got = asked.of_pairs(spark.createDataFrame(pairs, "query_id int, id int"))
    scores = {q: bm25(texts(), a) for q, a in ASKS}
    assert rows(got) == sorted(((q, i, round(scores[q][i], 6)) for q, i in pairs if i in scores[q]), key=repr)


def test_no_pairs_leave_the_tasks(docs, asks):
    """Only k hits per query of a task are shuffled, never the scores of (query, document) pairs."""
    plan = sparse_search(asks, build_sparse_index(docs), 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" in plan and "HashAggregate(keys=[query_id" not in plan
    for line in plan.split("\n"):
        assert not ("Exchange hashpartitioning" in line and "id#" in line.replace("query_id#", ""))


def test_a_block_below_the_bound_is_skipped(monkeypatch):
    import pyarrow as pa

    kept = []
    monkeypatch.setattr(sparse.BlockScan, "_keep", lambda self, ids, some, scores: kept.append(some.tolist()))
    scan = sparse.BlockScan(2, 1, ["id"], {"a": np.array([0, 1]), "b": np.array([1])}, {"a": 1.0, "b": 3.0}, 2.0)
    lists = {"ids": [1], "dls": [2], "terms": ["a", "b"], "starts": [0, 1], "most_tf": [1, 1], "least_dl": [2, 2], "places": [0, 0], "tfs": [1, 1]}
    block = {n: pa.array(v) for n, v in lists.items()}
    scan.floor[:] = 2.0  # above what "a" can give, below "a" and "b" together
    scan.add_block(block)
    scan.floor[:] = 9.0
    scan.add_block(block)
    assert kept == [[1]] or kept == [[1], []]


def test_empty_inputs(docs, asks):
    assert sparse_search(asks.limit(0), build_sparse_index(docs), 3).count() == 0
    assert sparse_search(asks, build_sparse_index(docs.limit(0)), 3).count() == 0


# --- hybrid ---


def brute_hybrid(corpus, vectors, asks, query_vectors, k, depth, alphas):
    out, depth = [], max(depth, k)
    for query, ask in asks:
        s = {i: round(v, 6) for i, v in bm25(corpus, ask).items()}
        good = [i for i, v in enumerate(vectors) if v is not None]
        scores = score_block("cosine", np.array([vectors[i] for i in good]), np.array([query_vectors[query]]))[:, 0]
        d = dict(zip(good, scores.tolist()))
        top = lambda side: sorted(side, key=lambda i: (-side[i], i))[:depth]
        union = set(top(d)) | set(top(s))
        in_d, in_s = [d[i] for i in union if i in d], [s.get(i, 0.0) for i in union]
        scale = lambda x, some: (x - min(some)) / (max(some) - min(some)) if max(some) > min(some) else 1.0
        alpha, found = alphas[query], []
        for i in range(len(corpus)):
            if i in d or i in s:
                fused = alpha * (scale(d[i], in_d) if i in d else 0.0) + (1 - alpha) * scale(s.get(i, 0.0), in_s)
                found.append((-round(fused, 6), i))
        out += [(query, r + 1, i, -f) for r, (f, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("depth, k, alpha", [(2, 3, 0.3), (3, 10, 0.8), (40, 5, None), (1_000, 200, 0.5)])
def test_hybrid_is_exact_over_the_whole_corpus(docs, asks, depth, k, alpha):
    """Short lists are deepened until no other document can matter."""
    asked = asks.where("query_id < 6").withColumn("alpha", F.when(F.col("query_id") == 2, 0.9))
    corpus = embed_texts(docs).withColumn("values", F.when(F.col("id") % 17 != 3, F.col("values")))
    vectors = [list(r["values"]) if r["values"] else None for r in corpus.orderBy("id").collect()]
    own = {r["query_id"]: r["query_vector"] for r in embed_texts(asked, "query_text", "query_vector").collect()}
    weights = {q: 0.9 if q == 2 else 0.5 if alpha is None else alpha for q, _ in ASKS}
    got = hybrid_search(asked, corpus, build_sparse_index(docs), k, alpha, depth)
    want = brute_hybrid(texts(), vectors, ASKS[:5], own, k, depth, weights)
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1]))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


def test_hybrid_without_queries(docs, asks):
    assert hybrid_search(asks.limit(0), embed_texts(docs), build_sparse_index(docs), 3).count() == 0


def test_blocks_and_batches_of_a_search_are_small(spark):
    text = " ".join(f"w{i}" for i in range(1_000))
    docs = spark.createDataFrame([(i, text) for i in range(300)], "id bigint, text string").coalesce(1)
    sizes = [r.n for r in build_sparse_index(docs).packed().select(F.size("places").alias("n")).collect()]
    assert sum(sizes) == 300_000 and max(sizes) <= 251_000
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert embed_texts(docs, "text", "values").select("values").distinct().count() == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m"
