"""Search queries. Query batches are derived from whole tables: the mean vector of every label,
and every benchmark passage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.collection import Collection, CollectionSpec
from lodestone.functions.ids import int_id
from lodestone.operators.ann import (
    ann_build,
    ann_search,
    mean_centroids,
    rerank_depth_search,
    train_centroids,
    write_index,
)
from lodestone.operators.dense import vector_search
from lodestone.operators.embed import HASHING, embed_texts
from lodestone.operators.filters import Filter, filter_advanced, filter_equality
from lodestone.operators.schema import MetadataSchema
from lodestone.operators.search import (
    hybrid_search,
    normalize_queries,
    rerank,
    result_projection,
    search_all_collections,
    text_search,
)
from lodestone.operators.sparse import build_sparse_index, sparse_search
from lodestone.plans.base import (
    SQL_CENTROIDS,
    query,
    sql_cosine,
    sql_embedding,
    sql_tokens,
    sql_top,
    table,
    text_table,
)
from lodestone.session import scratch_path

def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"), "label"
    )


def label_queries(spark: SparkSession, folder: str) -> DataFrame:
    means = mean_centroids(vectors(spark, folder), "label")
    return means.select(F.col("cell").alias("query_id"), F.col("centroid").alias("query_vector"))


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "documents").withColumnRenamed("doc_id", "id")


def text_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embed_texts(texts(spark, folder))


SQL_EXACT = "SELECT query_id, vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) AS score FROM q, embeddings"


@query("vector_search", f"WITH {SQL_CENTROIDS} {sql_top(SQL_EXACT, 10)}")
def _vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search(label_queries(spark, folder), vectors(spark, folder), 10)


@query("vector_search_grid", f"WITH {SQL_CENTROIDS} {sql_top(SQL_EXACT, 10)}")
def _vector_search_grid(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search(label_queries(spark, folder), vectors(spark, folder), 10, strategy="grid")


# Label 0 asks for 3 hits, label 1 for 25, the others for the default by 0 or null.
SQL_OWN_K = "CASE query_id WHEN 0 THEN 3 WHEN 1 THEN 25 ELSE 10 END"


def with_own_top_k(queries: DataFrame) -> DataFrame:
    place = F.col("query_id").cast("int")
    return queries.withColumn("top_k", F.when(place == 0, 3).when(place == 1, 25).when(place == 2, 0))


@query("vector_search_own_top_k", f"WITH {SQL_CENTROIDS} {sql_top(SQL_EXACT, SQL_OWN_K)}")
def _vector_search_own_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search(with_own_top_k(label_queries(spark, folder)), vectors(spark, folder), 10)


# Vectors of label 3 lose an element or get one that is no number: they match nothing.
@query("vector_search_bad_vectors", f"WITH {SQL_CENTROIDS} {sql_top(SQL_EXACT + ' WHERE embeddings.label <> 3', 10)}")
def _vector_search_bad_vectors(spark: SparkSession, folder: str) -> DataFrame:
    corpus = table(spark, folder, "embeddings")
    broken = F.when(F.col("vec_id") % 2 == 0, F.lit(float("nan")).cast("float"))
    values = F.when(F.col("label") == 3, F.concat(F.slice("embedding", 1, 63), F.array(broken))).otherwise(F.col("embedding"))
    return vector_search(label_queries(spark, folder), corpus.select(F.col("vec_id").alias("id"), values.alias("values")), 10)


SQL_L2 = "SELECT query_id, vec_id AS id, round(-list_distance(embedding::DOUBLE[], qv), 6) AS score FROM q, embeddings"


@query("vector_search_l2", f"WITH {SQL_CENTROIDS} {sql_top(SQL_L2, 10)}")
def _vector_search_l2(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search(label_queries(spark, folder), vectors(spark, folder), 10, "l2")


SQL_DOT = "SELECT query_id, vec_id AS id, round(list_dot_product(embedding::DOUBLE[], qv), 6) AS score FROM q, embeddings"


@query("vector_search_dot", f"WITH {SQL_CENTROIDS} {sql_top(SQL_DOT, 10)}")
def _vector_search_dot(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search(label_queries(spark, folder), vectors(spark, folder), 10, "dot")


@query(
    "normalize_queries",
    """SELECT item_id AS query_id,
  CASE WHEN item_id % 3 = 0 THEN 'alias ' || text ELSE text END AS query_text,
  CASE WHEN item_id % 4 IN (0, 2) THEN 10 ELSE (item_id % 4 - 2)::INTEGER END AS top_k,
  item_id % 5 <> 0 AS include_metadata, FALSE AS include_documents, FALSE AS include_embeddings,
  item_id % 3 <> 0 AS rerank_enabled,
  CASE WHEN item_id % 3 = 1 THEN 'local' WHEN item_id % 3 = 2 THEN 'other' END AS rerank_provider,
  CASE WHEN item_id % 3 <> 0 THEN 'coverage' END AS rerank_model
FROM benchmark""",
)
def _normalize_queries(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("item_id")
    requests = table(spark, folder, "benchmark").select(
        item.alias("query_id"),
        F.when(item % 3 == 0, "").otherwise(F.col("text")).alias("query_text"),
        F.concat(F.lit("alias "), "text").alias("search_text"),
        F.when(item % 4 == 0, 0).otherwise(item % 4 - 2).cast("int").alias("top_k"),
        F.when(item % 5 == 0, F.lit(False)).alias("include_metadata"),
        F.when(item % 3 == 1, "true")
        .when(item % 3 == 2, '{"enabled": true, "provider": "other"}')
        .alias("rerank"),
    )
    return normalize_queries(requests)


SQL_TEXT_VECTORS = f"{sql_embedding('bq', 'benchmark', 'item_id', 'text')}, {sql_embedding('dv', 'documents', 'doc_id', 'text')}"
SQL_TEXT_HITS = f"SELECT item_id AS query_id, doc_id AS id, {sql_cosine('bq.v', 'dv.v')} AS score FROM bq, dv"


@query("text_search", f"WITH {SQL_TEXT_VECTORS} {sql_top(SQL_TEXT_HITS, 10)}")
def _text_search(spark: SparkSession, folder: str) -> DataFrame:
    return text_search(text_queries(spark, folder), text_vectors(spark, folder), 10)


SQL_POSTINGS = f"""dt AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents),
dl AS (SELECT doc_id, len(t) AS dl FROM dt),
po AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM dt) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM po GROUP BY term)"""
SQL_BM25 = f"""{SQL_POSTINGS},
tot AS (SELECT count(*) AS n, avg(dl) AS av FROM dl),
qt AS (SELECT DISTINCT item_id AS query_id, unnest({sql_tokens('text')}) AS term FROM benchmark),
bm AS (SELECT query_id, doc_id AS id,
  round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / av))), 6) AS score
  FROM qt JOIN df USING (term) JOIN po USING (term) JOIN dl USING (doc_id), tot GROUP BY ALL)"""


@query("build_sparse_index", f"WITH {SQL_POSTINGS} SELECT term, doc_id AS id, dl, tf FROM po JOIN dl USING (doc_id)")
def _build_sparse_index(spark: SparkSession, folder: str) -> DataFrame:
    return build_sparse_index(texts(spark, folder)).postings


@query("sparse_term_stats", f"WITH {SQL_POSTINGS} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM po GROUP BY term")
def _sparse_term_stats(spark: SparkSession, folder: str) -> DataFrame:
    return build_sparse_index(texts(spark, folder)).term_stats()


@query("sparse_search", f"WITH {SQL_BM25} {sql_top('SELECT * FROM bm', 10)}")
def _sparse_search(spark: SparkSession, folder: str) -> DataFrame:
    return sparse_search(text_queries(spark, folder), build_sparse_index(texts(spark, folder)), 10)


@query("sparse_search_own_top_k", f"WITH {SQL_BM25} {sql_top('SELECT * FROM bm', SQL_OWN_K)}")
def _sparse_search_own_top_k(spark: SparkSession, folder: str) -> DataFrame:
    asked = with_own_top_k(text_queries(spark, folder))
    return sparse_search(asked, build_sparse_index(texts(spark, folder)), 10)


# The two lists of 100 set each query's scale; then every document is scored on both sides.
SQL_FUSED = f"""{SQL_TEXT_VECTORS}, {SQL_BM25},
va AS ({SQL_TEXT_HITS}),
al AS (SELECT va.query_id, va.id, va.score AS d, coalesce(bm.score, 0.0) AS s FROM va LEFT JOIN bm USING (query_id, id)),
un AS (SELECT query_id, id FROM ({sql_top('SELECT * FROM va', 100)}) UNION SELECT query_id, id FROM ({sql_top('SELECT * FROM bm', 100)})),
sc AS (SELECT query_id, min(d) AS dl, max(d) AS dh, min(s) AS sl, max(s) AS sh FROM un JOIN al USING (query_id, id) GROUP BY query_id)"""
SQL_FUSED_HITS = """SELECT query_id, id, round(0.3::DOUBLE * CASE WHEN dh > dl THEN (d - dl) / (dh - dl) ELSE 1.0 END
  + (1.0 - 0.3::DOUBLE) * CASE WHEN sh > sl THEN (s - sl) / (sh - sl) ELSE 1.0 END, 6) AS score FROM al JOIN sc USING (query_id)"""


@query("hybrid_search", f"WITH {SQL_FUSED} {sql_top(SQL_FUSED_HITS, 10)}")
def _hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    index = build_sparse_index(texts(spark, folder))
    return hybrid_search(text_queries(spark, folder), text_vectors(spark, folder), index, 10, alpha=0.3)


SQL_LABELLED = "(SELECT doc_id, text, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with declared columns ``lang`` and ``n_chars``; the rest of the metadata as a variant."""
    docs = texts(spark, folder).join(table(spark, folder, "labels").withColumnRenamed("doc_id", "id"), "id", "left")
    loose = F.parse_json(F.to_json(F.struct("source", "quality", "toxic")))
    return docs.select("id", "text", "lang", "n_chars", loose.alias("metadata"))


@query(
    "filter_equality",
    f"""WITH fd AS (SELECT doc_id, text FROM {SQL_LABELLED} WHERE lang = 'en' AND quality = 1),
{sql_embedding('bq', 'benchmark', 'item_id', 'text')}, {sql_embedding('dv', 'fd', 'doc_id', 'text')}
{sql_top(SQL_TEXT_HITS, 10)}""",
)
def _filter_equality(spark: SparkSession, folder: str) -> DataFrame:
    passing = filter_equality(labelled(spark, folder), {"lang": "en", "quality": "1"})
    return text_search(text_queries(spark, folder), embed_texts(passing), 10)


@query(
    "filter_advanced",
    f"""SELECT doc_id AS id, lang, n_chars FROM (SELECT doc_id, lang, n_chars, source, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id))
WHERE lang IN ('en', 'fr', 'de') AND n_chars BETWEEN 100 AND 5000 AND n_chars >= 150 AND lang <> 'de'
  AND starts_with(source, 'src1') AND contains(source, '1') AND (toxic IS NULL OR toxic <> 1)
  AND (quality IS NULL OR quality NOT IN (0))""",
)
def _filter_advanced(spark: SparkSession, folder: str) -> DataFrame:
    filters = [
        Filter("lang", "in", values=("en", "fr", "de")),
        Filter("n_chars", "between", values=(100, 5000)),
        Filter("n_chars", "gte", 150),
        {"field": "lang", "op": "ne", "value": "de"},
        {"field": "source", "op": "prefix", "value": "src1"},
        {"field": "source", "op": "contains", "value": "1"},
        {"field": "toxic", "op": "ne", "value": "1"},
        {"field": "quality", "op": "not_in", "values": ["0"]},
    ]
    return filter_advanced(labelled(spark, folder), filters).select("id", "lang", "n_chars")


# Through a collection whose declared fields are stored as columns.
@query(
    "filter_typed",
    f"""WITH fd AS (SELECT doc_id, text FROM documents WHERE n_chars BETWEEN 200 AND 4000 AND n_chars > 250.5 AND lang IN ('en', 'es')
  AND source <> 'src3'),
{sql_embedding('bq', 'benchmark', 'item_id', 'text')}, {sql_embedding('dv', 'fd', 'doc_id', 'text')}
{sql_top(SQL_TEXT_HITS, 5)}""",
)
def _filter_typed(spark: SparkSession, folder: str) -> DataFrame:
    schema = MetadataSchema((("n_chars", "u32"), ("lang", "string")))
    spec = CollectionSpec("documents", provider=HASHING[0], model=HASHING[1], schema=schema)
    made = Collection.create(spark, scratch_path(spark, "documents"), spec)
    fields = {"n_chars": F.col("n_chars").cast("string"), "lang": F.col("lang"), "source": F.col("source")}
    records = text_vectors(spark, folder).select(
        int_id(F.col("id")).alias("id"),
        "values",
        F.create_map(*[c for n, v in fields.items() for c in (F.lit(n), v)]).alias("metadata"),
        F.col("id").alias("position"),
    )
    made.insert(records)
    made.compact()
    filters = [
        Filter("n_chars", "between", values=(200, 4000)),
        Filter("n_chars", "gt", 250.5),
        Filter("lang", "in", values=("en", "es")),
        Filter("source", "ne", "src3"),
    ]
    hits = made.search(text_queries(spark, folder), 5, advanced_filters=filters, include_metadata=False)
    return hits.select("query_id", "rank", F.col("id.i").alias("id"), "score")


SQL_CELLS = f"""{SQL_CENTROIDS},
ce AS (SELECT vec_id, query_id AS cell FROM (SELECT vec_id, query_id, row_number() OVER (PARTITION BY vec_id ORDER BY
  round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) DESC, query_id) AS r FROM embeddings, q) WHERE r = 1),
pk AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) AS p FROM embeddings),
co AS (SELECT vec_id, e, list_transform(e, lambda x: floor(127.0::DOUBLE * x / p + 0.5::DOUBLE)) AS codes, p / 127.0::DOUBLE AS scale FROM pk)"""


def built_index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = vectors(spark, folder)
    centroids = mean_centroids(rows, "label")
    return ann_build(rows, centroids), centroids


@query(
    "ann_build",
    f"""WITH {SQL_CELLS} SELECT vec_id AS id, cell, list_sum(codes)::BIGINT AS code_sum,
  list_sum(list_transform(codes, lambda x: x * x))::BIGINT AS code_norm, round(scale, 9) AS scale
FROM ce JOIN co USING (vec_id)""",
)
def _ann_build(spark: SparkSession, folder: str) -> DataFrame:
    index, _ = built_index(spark, folder)
    wide = F.transform("codes", lambda c: c.cast("bigint"))
    return index.select(
        "id",
        F.col("cell").cast("int").alias("cell"),
        F.aggregate(wide, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("code_sum"),
        F.aggregate(wide, F.lit(0).cast("bigint"), lambda a, x: a + x * x).alias("code_norm"),
        F.round("scale", 9).alias("scale"),
    )


SQL_PROBES = """pr AS (SELECT query_id, qv, cell FROM (SELECT a.query_id, a.qv, b.query_id AS cell, row_number() OVER (
  PARTITION BY a.query_id ORDER BY round(list_cosine_similarity(b.qv, a.qv), 6) DESC, b.query_id) AS r FROM q a, q b) WHERE r <= 3)"""
SQL_ANN = """SELECT query_id, vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], qv), 6) AS score
FROM pr JOIN ce USING (cell) JOIN embeddings USING (vec_id)"""


def stored_index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    index, centroids = built_index(spark, folder)
    return write_index(index, scratch_path(spark, "cells")), centroids


@query("ann_search", f"WITH {SQL_CELLS}, {SQL_PROBES} {sql_top(SQL_ANN, 10)}")
def _ann_search(spark: SparkSession, folder: str) -> DataFrame:
    index, centroids = stored_index(spark, folder)
    return ann_search(label_queries(spark, folder), index, centroids, 10, nprobe=3)


@query("ann_search_own_top_k", f"WITH {SQL_CELLS}, {SQL_PROBES} {sql_top(SQL_ANN, SQL_OWN_K)}")
def _ann_search_own_top_k(spark: SparkSession, folder: str) -> DataFrame:
    index, centroids = stored_index(spark, folder)
    return ann_search(with_own_top_k(label_queries(spark, folder)), index, centroids, 10, nprobe=3)


# Both knobs: the codes of 3 probed cells, the vectors of the best 40 of each query.
SQL_PROBED_CODES = """SELECT query_id, vec_id AS id, e, qv, round(list_cosine_similarity(list_transform(codes, lambda x: x * scale), qv), 6) AS score
FROM pr JOIN ce USING (cell) JOIN co USING (vec_id)"""
SQL_BOTH = f"cd AS ({sql_top(SQL_PROBED_CODES, 40, keep='query_id, id, e, qv')})"
SQL_COARSE = "SELECT query_id, vec_id AS id, e, qv, round(list_dot_product(list_transform(codes, lambda x: x * scale), qv), 6) AS score FROM q, co"
SQL_DEPTH = f"""cd AS ({sql_top(SQL_COARSE, 100, keep='query_id, id, e, qv')})"""
SQL_DEPTH_HITS = "SELECT query_id, id, round(list_cosine_similarity(e, qv), 6) AS score FROM cd"


@query("ann_search_depth", f"WITH {SQL_CELLS}, {SQL_PROBES}, {SQL_BOTH} {sql_top(SQL_DEPTH_HITS, 10)}")
def _ann_search_depth(spark: SparkSession, folder: str) -> DataFrame:
    index, centroids = stored_index(spark, folder)
    return ann_search(label_queries(spark, folder), index, centroids, 10, nprobe=3, depth=40)


# Centroids trained on every vector: with all cells probed the hits are the exact ones.
@query("ann_search_trained", f"WITH {SQL_CENTROIDS} {sql_top(SQL_EXACT, 10)}")
def _ann_search_trained(spark: SparkSession, folder: str) -> DataFrame:
    rows = vectors(spark, folder)
    centroids = train_centroids(rows)
    index = write_index(ann_build(rows, centroids), scratch_path(spark, "trained"))
    return ann_search(label_queries(spark, folder), index, centroids, 10, nprobe=centroids.count())


@query("rerank_depth_search", f"WITH {SQL_CELLS}, {SQL_DEPTH} {sql_top(SQL_DEPTH_HITS, 10)}")
def _rerank_depth_search(spark: SparkSession, folder: str) -> DataFrame:
    index, _ = built_index(spark, folder)
    return rerank_depth_search(label_queries(spark, folder), index, 10)


SQL_RERANK = f"""{SQL_TEXT_VECTORS}, fs AS ({sql_top(SQL_TEXT_HITS, 20)}),
qs AS (SELECT item_id AS query_id, list_distinct({sql_tokens('text')}) AS t FROM benchmark),
ds AS (SELECT doc_id AS id, {sql_tokens('text')} AS t FROM documents)"""
SQL_RERANK_HITS = """SELECT query_id, id, fs.score AS first_score,
  CASE WHEN len(qs.t) > 0 THEN round(len(list_intersect(qs.t, ds.t)) / len(qs.t), 6) ELSE 0.0 END AS score
FROM fs JOIN qs USING (query_id) JOIN ds USING (id)"""


@query(
    "rerank",
    f"WITH {SQL_RERANK} "
    + sql_top(SQL_RERANK_HITS, 10, "score DESC, first_score DESC, id", "query_id, rank, id, score, first_score"),
)
def _rerank(spark: SparkSession, folder: str) -> DataFrame:
    queries = text_queries(spark, folder)
    hits = text_search(queries, text_vectors(spark, folder), 20)
    return rerank(hits, queries, texts(spark, folder), 10)


@query(
    "result_projection",
    f"""WITH {SQL_CENTROIDS}, h AS ({sql_top(SQL_EXACT, 10)})
SELECT query_id, rank, id, score, label, round(list_sum(embedding::DOUBLE[]), 6) AS embedding_sum
FROM h JOIN embeddings ON vec_id = id""",
)
def _result_projection(spark: SparkSession, folder: str) -> DataFrame:
    records = vectors(spark, folder)
    hits = vector_search(label_queries(spark, folder), records, 10)
    wide = result_projection(hits, records, "label", include_embeddings=True)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return wide.withColumn("embedding_sum", F.round(total, 6)).drop("embedding")


SQL_UNION = f"""cs AS (SELECT 'msg-' || conv_id || '-' || turn AS mid, text FROM conversations),
{sql_embedding('bq', 'benchmark', 'item_id', 'text')}, {sql_embedding('dv', 'documents', 'doc_id', 'text')}, {sql_embedding('mv', 'cs', 'mid', 'text')}"""
SQL_UNION_HITS = f"""SELECT item_id AS query_id, 'documents' AS collection, 'doc-' || doc_id AS id, {sql_cosine('bq.v', 'dv.v')} AS score FROM bq, dv
UNION ALL SELECT item_id, 'messages', mid, {sql_cosine('bq.v', 'mv.v')} FROM bq, mv"""


@query(
    "search_all_collections",
    f"WITH {SQL_UNION} "
    + sql_top(SQL_UNION_HITS, 10, "score DESC, collection, id", "query_id, rank, collection, id, score"),
)
def _search_all_collections(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_vectors(spark, folder).withColumn("id", F.concat(F.lit("doc-"), "id"))
    messages = text_table(spark, folder, "conversations").select(
        F.concat(F.lit("msg-"), "conv_id", F.lit("-"), "turn").alias("id"), "text"
    )
    queries = embed_texts(text_queries(spark, folder), "query_text", "query_vector")
    return search_all_collections(queries, {"documents": docs, "messages": embed_texts(messages)}, 10)
