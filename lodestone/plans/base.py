"""The registry of queries and the SQL shared by several of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.session import spread_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose texts cost enough work per row to want every core."""
    rows = table(spark, folder, name)
    return spread_small(rows.select(*columns) if columns else rows)


def sql_tokens(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


def sql_embedding(name: str, source: str, key: str, text: str, dim: int = 64) -> str:
    """CTEs ending in ``name``: the hashed vector ``v`` of ``text`` per ``key``, with ``extra`` columns kept."""
    bucket = f"('0x' || substr(md5(t), 1, 8))::BIGINT % {dim}"
    return f"""{name}_b AS (SELECT {key}, list_transform({sql_tokens(text)}, lambda t: {bucket}) AS b FROM {source}),
{name}_c AS (SELECT {key}, list_transform(range({dim}), lambda i: len(list_filter(b, lambda x: x = i))::DOUBLE) AS c FROM {name}_b),
{name}_n AS (SELECT {key}, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS n FROM {name}_c),
{name} AS (SELECT {key}, list_transform(c, lambda x: CASE WHEN n > 0 THEN (x / n)::FLOAT ELSE 0::FLOAT END)::DOUBLE[] AS v FROM {name}_n)"""


def sql_cosine(a: str, b: str) -> str:
    return (
        f"CASE WHEN list_sum(list_transform({a}, lambda x: x * x)) = 0 OR list_sum(list_transform({b}, lambda x: x * x)) = 0 "
        f"THEN 0.0 ELSE round(list_cosine_similarity({a}, {b}), 6) END"
    )


def sql_top(hits: str, k: int, order: str = "score DESC, id", keep: str = "query_id, rank, id, score") -> str:
    """Rank the rows of a subquery per query and keep ``k``."""
    return (
        f"SELECT {keep} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank "
        f"FROM ({hits})) WHERE rank <= {k}"
    )


# Mean vector of each label: the queries of the vector searches, and the cells of the index.
SQL_CENTROIDS = """u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT label, i, round(avg(x), 6) AS x FROM u GROUP BY ALL),
q AS (SELECT label AS query_id, list(x ORDER BY i) AS qv FROM m GROUP BY ALL)"""
