"""Positions and running totals within a group, without one task per group.

A window over a whole group would put a hot group on one task. Here the order column is cut
into ranges of ``width`` values; each (group, range) is a small window, and the totals of the
ranges before it are added from a table with one row per range. Rows without an order value come
last, in no fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WIDTH = 65_536
#: Range of the rows without an order value.
LAST_RANGE = (1 << 63) - 1


def _range_of(col: str, width: int) -> Column:
    return F.coalesce(F.floor(F.col(col) / F.lit(width)).cast("bigint"), F.lit(LAST_RANGE))


def running_total(
    df: DataFrame, keys: list[str], order: str, value: Column, out: str, width: int = WIDTH
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the group's rows up to and including this one.

    ``order`` is an integer column, unique within its group and without wide gaps.
    """
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    rows = df.withColumns({"__g": group, "__r": _range_of(order, width), "__v": value})
    before = W.partitionBy("__g").orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        rows.groupBy("__g", "__r")
        .agg(F.sum("__v").alias("__t"))
        .select("__g", "__r", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__b"))
    )
    inside = W.partitionBy("__g", "__r").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.join(ranges, ["__g", "__r"])
        .withColumn(out, F.col("__b") + F.sum("__v").over(inside))
        .drop("__g", "__r", "__v", "__b")
    )


def row_position(df: DataFrame, keys: list[str], order: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add ``out``: the 0-based position of the row within its group by ``order``."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out, width).withColumn(
        out, F.col(out) - 1
    )


def preceding_rows(
    df: DataFrame, keys: list[str], order: str, n: int, item: Column, out: str, width: int = WIDTH
) -> DataFrame:
    """Add ``out``: ``item`` of the ``n`` rows before this one, oldest first.

    Each range of positions also gets copies of the last ``n`` rows of the range before it.
    """
    width = max(width, n)
    rows = row_position(df, keys, order, "__p", width).withColumn("__item", item)
    rows = rows.withColumn("__r", _range_of("__p", width))
    spill = F.pmod(F.col("__p"), F.lit(width)) >= width - n
    homes = F.when(spill, F.array(F.col("__r"), F.col("__r") + 1)).otherwise(F.array(F.col("__r")))
    rows = rows.withColumn("__home", F.explode(homes))
    frame = W.partitionBy(*keys, "__home").orderBy("__p").rowsBetween(-n, -1)
    return (
        rows.withColumn(out, F.collect_list("__item").over(frame))
        .where(F.col("__home") == F.col("__r"))
        .drop("__p", "__item", "__r", "__home")
    )
