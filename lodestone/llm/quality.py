"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A text is read as words and runs of signs; a token equal to the one before it counts as a stutter.
Its unigrams and bigrams fall into ``BUCKETS`` buckets. The target model counts the documents
labelled good, the raw model all documents; the log weight of a document is the mean over its
n-grams of ``ln(target / raw)`` with one added to every bucket, times ``SAMPLE`` n-grams. Adding
Gumbel noise and keeping the largest ``k`` draws ``k`` documents without replacement with
probabilities proportional to their weights; the noise is a hash of the id.

Both models have a fixed size. Every task counts its part into arrays and sends bucket totals.
The k-th largest value is found by histograms, so no task sorts all rows. Null and empty texts
have no n-grams, a null weight, and are not drawn; rows that tie with the k-th are all drawn.
Labels without document teach nothing. Without good labels all weights are equal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import small_batches, stored, text_of
from lodestone.operators.topk import join_counted

BUCKETS = 1 << 16
SAMPLE = 50
KEEP = 0.5
SEED = 7
BINS = 4_096
LAST = 10_000

TOKEN = re.compile(r"\w+|[^\w\s]+")
STUTTER = 0x5EED
REMEMBERED = 200_000


class Grams:
    """Buckets of the n-grams of texts."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, tokens: list[str]) -> list[int]:
        import xxhash

        known, out = self.known, []
        if len(known) > REMEMBERED:
            known.clear()
        for t in tokens:
            h = known.get(t)
            if h is None:
                h = known[t] = xxhash.xxh32_intdigest(t)
            out.append(h)
        return out

    def buckets(self, text: str) -> np.ndarray:
        one = np.array(self.hashes(TOKEN.findall(text)), np.uint64)
        if not len(one):
            return one
        again = np.concatenate([[False], one[1:] == one[:-1]])
        one = np.where(again, np.uint64(STUTTER), one)
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        two ^= two >> np.uint64(29)
        return np.concatenate([one, two * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)]) % np.uint64(BUCKETS)


def models(documents: DataFrame, good: DataFrame) -> np.ndarray:
    """``ln(target / raw)`` per bucket, counted over all documents; ``good`` has the target's ``doc_id``."""
    ids = good.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = join_counted(rows, ids, "doc_id", "left").select(F.coalesce("target", F.lit(False)).alias("target"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for target, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.bincount(grams.buckets(text).astype(np.int64), minlength=BUCKETS)
                total[0] += n
                if target:
                    total[1] += n
        held = np.nonzero(total[0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[0][held]), pa.array(total[1][held])], ["bucket", "raw", "target"])

    counts = rows.mapInArrow(count, "bucket long, raw long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    table = np.zeros((2, BUCKETS))
    for r in counts.collect():  # at most BUCKETS rows
        table[:, r.bucket] = r.raw, r.target
    if not table[1].any():
        return np.zeros(BUCKETS)
    share = (table + 1) / (table.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(share[1] / share[0])


def weigh(documents: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_grams`` and ``log_weight`` per row."""

    @F.arrow_udf("struct<n_grams:bigint,log_weight:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grams = Grams()
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                held = grams.buckets(text)
                mean = float(ratio[held.astype(np.int64)].mean()) * SAMPLE if len(held) else None
                out.append({"n_grams": len(held), "log_weight": mean})
            yield pa.array(out, pa.struct([("n_grams", pa.int64()), ("log_weight", pa.float64())]))

    return documents.select("doc_id", score(text_of("text")).alias("s")).select("doc_id", "s.*")


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls, or None if there are fewer."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or n < k:
        return None
    part = rows.select(F.col(column).alias("v"))
    while n > LAST and low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1)).cast("int")
        bins = sorted(part.groupBy(place.alias("bin")).agg(F.count("*"), F.min("v"), F.max("v")).collect(), reverse=True)
        for _, n, least, most in bins:
            if n >= k:
                break
            k -= n
        if (least, most) == (low, high):
            break
        low, high = least, most
        part = part.where(F.col("v").between(low, high))
    return low if low == high else part.orderBy(F.desc("v")).limit(k).agg(F.min("v")).first()[0]


def resample(documents: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``doc_id``, ``n_grams``, ``log_weight``, ``draw`` (with noise) and ``selected`` per row.

    Draws the fraction ``keep`` of all rows.
    """
    small_batches(documents.sparkSession)
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = weigh(documents, models(documents, good))
    unit = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = stored(rows.withColumn("draw", F.col("log_weight") - F.log(-F.log(unit))), "weights")
    least = kth_largest(rows.where("draw IS NOT NULL"), "draw", int(keep * rows.count()))
    taken = F.col("draw").isNotNull() & F.lit(True) if least is None else F.coalesce(F.col("draw") >= least, F.lit(False))
    return rows.withColumn("selected", taken)
