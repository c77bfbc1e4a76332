"""Cutting texts and tables into chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import words
from lodestone.operators.ordering import row_position

CHUNK_WORDS = 120
CHUNK_STRIDE = 100


def chunk_text(docs: DataFrame, size: int = CHUNK_WORDS, stride: int = CHUNK_STRIDE, text: str = "text") -> DataFrame:
    """One row per window of ``size`` words, a new one every ``stride`` words.

    Adds a 0-based ``chunk_index`` and replaces the text by the window's. The last window is
    the first to reach the end of the text; a text without words gives one empty chunk.
    """
    if not 0 < stride <= size:
        raise ValueError("stride must lie in 1..size")
    split = docs.withColumn("__w", words(F.coalesce(F.col(text), F.lit("")))).drop(text)
    n = F.size("__w")
    last = F.ceil(F.greatest(n - F.lit(size), F.lit(0)) / F.lit(stride)).cast("int")

    def window(i: Column) -> Column:
        # word by word: within a lambda, ``slice`` would copy all words first
        places = F.sequence(i * stride, F.least(i * stride + size, n) - 1)
        return F.array_join(F.transform(places, lambda j: F.get("__w", j)), " ")

    # Cut within the row: a row per window that carries all words would cost the square of a text's length.
    # There is always a window. From ``posexplode`` Spark would infer a filter that cuts the texts a second time.
    kept = [c for c in docs.columns if c not in (text, "chunk_index")]
    cut = split.withColumn("__c", F.transform(F.sequence(F.lit(0), last), window))
    cut = cut.select(*[F.col(f"`{c}`") for c in kept], F.posexplode_outer("__c").alias("__i", "__t"))
    new = {text: F.coalesce("__t", F.lit("")).alias(text)}
    return cut.select(
        *[new.get(c, F.col(f"`{c}`")) for c in docs.columns if c != "chunk_index"], F.coalesce("__i", F.lit(0)).alias("chunk_index")
    )


def chunk_table_rows(
    rows: DataFrame, sheet: str, order: str, columns: list[str], size: int = 20
) -> DataFrame:
    """Groups of ``size`` consecutive rows of each sheet, with 1-based inclusive row bounds.

    Text is one JSON object per row, a line each.
    """
    placed = row_position(rows, [sheet], order, "__n")
    cells = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    bucket = F.floor(F.col("__n") / F.lit(size))
    grouped = placed.select(F.col(sheet).alias("sheet_name"), bucket.alias("chunk_index"), "__n", cells.alias("__c"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("__n", "__c"))), lambda x: x["__c"])
    return grouped.groupBy("sheet_name", "chunk_index").agg(
        (F.min("__n") + 1).alias("row_start"),
        (F.max("__n") + 1).alias("row_end"),
        F.array_join(lines, "\n").alias("text"),
    ).withColumn("column_names", F.array(*[F.lit(c) for c in columns]))
