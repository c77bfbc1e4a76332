"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below
the shared folder and hands what it reads back to the next one. Toxic documents, all but one of a
group of near duplicates and documents that hold benchmark items go, secrets are masked, and the
last stage turns each text into token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, near, pieces, secrets, toxicity
from lodestone.llm.common import fresh, stored

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``; the lexicon is learned from labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fresh(docs, "score")
    return toxicity.toxicity(docs, labels, out=score).where(F.col(score) < TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of texts alike in their five-word shingles."""
    return near.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and whether these decode to the text."""
    ids, decoded = fresh(docs, "ids"), fresh(docs, "decoded")
    rows = pieces.decode(pieces.encode(docs, out=ids), ids, decoded)
    exact = F.col(decoded) == F.coalesce(F.col("text"), F.lit(""))
    return rows.withColumn(fresh(docs, "round_trip"), exact).drop(decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("secrets", mask_secrets),
    ("sentencepiece", tokenize),
]

#: SQL can express neither the learned grammar nor the fingerprints: tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
