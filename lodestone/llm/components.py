"""Connected components of a table of links, by alternating large and small stars.

Each round is a few joins and minimum aggregations over the links, written to the shared folder;
the driver sees only a row count and a checksum. A hub's links are joined with one row, so Spark
can split them, and minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node reachable, for every node that has a link.

    ``links`` has integer columns ``a`` and ``b``; null, repeated, mirrored and reflexive links are
    harmless.
    """
    rows = links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    rows = stored(rows.distinct(), "links")
    mark = _mark(rows)
    while True:
        rows = stored(_small_star(_large_star(rows)), "links")
        last, mark = mark, _mark(rows)
        if mark == last:
            break
    nodes = rows.select(F.col("v").alias("node"), F.col("u").alias("root"))
    roots = rows.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return nodes.unionAll(roots)


def _mark(rows: DataFrame) -> tuple:
    return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _large_star(rows: DataFrame) -> DataFrame:
    """Every neighbour larger than a node moves to the node's smallest neighbour."""
    both = rows.unionAll(rows.select(F.col("u").alias("v"), F.col("v").alias("u")))
    low = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("u"), F.least("v", "m").alias("m"))
    return both.where("v > u").join(low, "u").select("v", F.col("m").alias("u"))


def _small_star(rows: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    rows = rows.where("v > u").distinct()
    low = rows.groupBy("v").agg(F.min("u").alias("m"))
    moved = rows.join(low, "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionAll(low.select("v", F.col("m").alias("u"))).distinct()
