"""Ranked top-k per query.

Every ranking in the package is ``score desc, id asc`` over scores already rounded, so the
order does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

LIMIT_THRESHOLD = 1_000  # default of spark.sql.optimizer.windowGroupLimitThreshold
SALTS = 64
FETCH_ROWS = 1_000_000  # largest key list sent to every task


def rank_hits(
    hits: DataFrame,
    k: int,
    by: tuple[str, ...] = ("query_id",),
    order: list[Column] | None = None,
) -> DataFrame:
    """Keep the ``k`` best rows of each query and add their 1-based ``rank``.

    The literal bound lets Spark keep ``k`` rows per query in every map task before the shuffle.
    It does so up to a threshold; beyond it, each query is ranked in parts first.
    """
    order = order or [F.col("score").desc(), F.col("id").asc()]
    window = W.partitionBy(*by).orderBy(*order)
    if k > LIMIT_THRESHOLD:
        part = F.pmod(F.xxhash64("id"), F.lit(SALTS))
        place = F.row_number().over(W.partitionBy(*by, "__part").orderBy(*order))
        hits = hits.withColumn("__part", part).withColumn("__place", place).where(F.col("__place") <= k)
        hits = hits.drop("__part", "__place")
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def own_top_k(k: int) -> Column:
    """The depth a query asks for in its ``top_k``; null and 0 ask for ``k``."""
    return F.coalesce(F.nullif(F.col("top_k").cast("int"), F.lit(0)), F.lit(k))


def deepest(queries: DataFrame, k: int) -> int:
    """The depth to rank to: the largest that any query asks for."""
    if "top_k" not in queries.columns:
        return k
    return max(queries.agg(F.max(own_top_k(k))).first()[0] or k, 1)


def limit_per_query(hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Cut hits ranked to ``deepest`` to each query's own ``top_k``, if the queries have one."""
    if "top_k" not in queries.columns:
        return hits
    limits = queries.select("query_id", own_top_k(k).alias("__k"))
    return hits.join(limits, "query_id").where(F.col("rank") <= F.col("__k")).drop("__k")


def join_counted(wide: DataFrame, small: DataFrame, on: str | list[str], how: str, max_rows: int = FETCH_ROWS) -> DataFrame:
    """Join a table of narrow rows to a large one, which stays in place while they are few.

    ``small`` is counted first and should be cheap to read twice.
    """
    bounded = small.limit(max_rows + 1).count() <= max_rows
    return wide.join(F.broadcast(small) if bounded else small, on, how)


def rows_of(wide: DataFrame, keys: DataFrame, on: str, max_rows: int = FETCH_ROWS) -> DataFrame:
    """The rows of a large table that a small one names, without shuffling the large one.

    Up to ``max_rows`` distinct keys are sent to the scan; with more, the semi join shuffles
    both sides by key.
    """
    return join_counted(wide, keys.select(on).distinct(), on, "left_semi", max_rows)


def without_rows_of(wide: DataFrame, keys: DataFrame, on: str, max_rows: int = FETCH_ROWS) -> DataFrame:
    """The rows of a large table that a small one does not name; see ``rows_of``."""
    return join_counted(wide, keys.select(on).distinct(), on, "left_anti", max_rows)


def with_rows(hits: DataFrame, wide: DataFrame, on: str = "id", how: str = "inner") -> DataFrame:
    """Attach columns of a large table to ranked hits.

    The ranking is materialised once; only the rows it names leave the scan of the large table.
    """
    hits = cut_lineage(hits)
    return hits.join(rows_of(wide, hits, on), on, how)
