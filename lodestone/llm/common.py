"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import scratch_path
from lodestone.workers import give_back, lean, small_batches

__all__ = ["fresh", "give_back", "lean", "once_per_worker", "parts", "small_batches", "stored", "text_of"]


def text_of(column: str) -> Column:
    """A text column in which null reads as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Cuts the lineage: what follows reads files that survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def once_per_worker(spark: SparkSession, data, build):
    """A function for tasks that returns ``build(data)``, made once per Python worker process.

    ``data`` is plain data of a fixed size, such as the contents of a vocabulary file.
    """
    held = spark.sparkContext.broadcast([data])

    def get():
        slot = held.value
        if len(slot) == 1:
            slot.append(build(slot[0]))
        return slot[1]

    return get
