"""Contexts for questions, citations per source, inline citation marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.dense import vector_search
from lodestone.operators.embed import DEFAULT_DIM, embed_texts
from lodestone.operators.search import hybrid_search, text_search
from lodestone.operators.sparse import SparseIndex
from lodestone.operators.topk import with_rows

DEFAULT_CONTEXT = 5
PREVIEW_CHARS = 200

CHUNK_FIELDS = ("doc_id", "chunk_index", "source", "page", "sheet_name", "text")


def chunk_vectors(chunks: DataFrame, dim: int = DEFAULT_DIM) -> DataFrame:
    """Chunks as a searchable corpus: id is the pair (document, chunk index)."""
    keyed = chunks.withColumn("id", F.struct("doc_id", "chunk_index"))
    return embed_texts(keyed, "text", "values", dim=dim)


def retrieve_context(
    questions: DataFrame,
    chunks: DataFrame,
    k: int = 0,
    index: SparseIndex | None = None,
    alpha: float | None = None,
) -> DataFrame:
    """The best chunks of each question with their text and place.

    ``questions`` is ``query_id, query_text`` or ``query_id, query_vector``; ``chunks`` comes
    from ``chunk_vectors``. With a sparse ``index`` over the chunks the search is hybrid. k of
    zero or less means 5.
    """
    k = k if k > 0 else DEFAULT_CONTEXT
    if "query_vector" in questions.columns:
        hits = vector_search(questions, chunks, k)
    elif index is not None:
        hits = hybrid_search(questions, chunks, index, k, alpha)
    else:
        hits = text_search(questions, chunks, k)
    wide = chunks.select("id", *[c for c in CHUNK_FIELDS if c in chunks.columns])
    return with_rows(hits, wide)


def aggregate_citations(context: DataFrame, include_sources: bool = True) -> DataFrame | None:
    """One row per question and source document, numbered by relevance.

    Relevance is the best chunk's score and the preview its first 200 characters. A group holds
    at most the question's k chunks, so its lists are bounded. ``include_sources=False`` gives
    no citations at all.
    """
    if not include_sources:
        return None
    best_first = F.struct((-F.col("score")).alias("s"), "chunk_index", "text")
    nested = F.struct("rank", "chunk_index", "score", "text")
    aggregates = [
        F.max("score").alias("relevance"),
        F.count("*").alias("chunk_count"),
        F.substring(F.min(best_first)["text"], 1, PREVIEW_CHARS).alias("preview"),
        F.sort_array(F.collect_list(nested)).alias("chunks"),
    ]
    if "page" in context.columns:
        aggregates.append(F.sort_array(F.collect_set("page")).alias("pages"))
    if "sheet_name" in context.columns:
        aggregates.append(F.sort_array(F.collect_set("sheet_name")).alias("sheet_names"))
    keys = ["query_id", "doc_id"] + (["source"] if "source" in context.columns else [])
    grouped = context.groupBy(*keys).agg(*aggregates)
    order = W.partitionBy("query_id").orderBy(F.col("relevance").desc(), F.col("doc_id").asc())
    return grouped.withColumn("citation", F.row_number().over(order))


def resolve_inline_citations(answers: DataFrame, citations: DataFrame) -> DataFrame:
    """Each ``[n]`` of an answer with the n-th source of that answer.

    Marks beyond the last source stay, with a null source; numbers beyond 32 bits have a null citation.
    """
    marks = answers.select(
        "query_id", F.posexplode(F.regexp_extract_all("answer", F.lit(r"\[(\d+)\]"), F.lit(1))).alias("mark", "n")
    ).withColumn("citation", F.col("n").try_cast("int")).drop("n")
    return marks.join(citations.select("query_id", "citation", "doc_id"), ["query_id", "citation"], "left").select(
        "query_id", "mark", "citation", "doc_id"
    )
