"""Near-duplicates by the Jaccard similarity of word shingles: five words, at least 0.8.

Candidates come from SimHash fingerprints of the shingles first, met at the anchor points of ``simhash``:
fingerprints within 3 bits, and sets of one fingerprint. No distance of 64-bit fingerprints bounds the
similarity (documents 1 and 177 of the smallest test table have 0.83 and 17 differing bits), so what the
anchors have not connected is looked for by min-hashes: ``BANDS`` keys of ``ROWS`` minima each. A pair
at 0.8 shares none with probability (1 - 0.8**4)**40 < 1e-9, one above it less often. Every candidate is
checked on the shingles themselves, held as 64-bit hashes.

Texts with equal sets are one row. Rows of a key are checked against its smallest first; keys whose
rows are then not all connected are compared in a grid of blocks, which send on spanning forests.

Words are those of ``simhash``; a text of one to four words is one shingle. Texts without words are
alike and like no other. Rows are named by a 64-bit hash of the set. Null and repeated ids: see ``simhash``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import simhash
from lodestone.llm.common import lean, small_batches, stored, text_of
from lodestone.llm.components import components
from lodestone.operators.topk import join_counted, rows_of

SHINGLE = 5
#: The least similarity, as a fraction of whole numbers.
SHARE = (4, 5)
BANDS, ROWS = 40, 4
#: Rows of one key that are compared in one block.
BLOCK = 512
#: Bytes of the sets that are sent on at once, about.
HELD = 1 << 21
_FACTORS = np.random.default_rng(5).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.random.default_rng(6).integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingles_of(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[i:j], 42) for i, j in zip(starts, stops)], np.uint64))


def print_of(shingles: np.ndarray) -> int:
    """The name of a set, as a signed number."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 7)).view(np.int64))


def bands_of(shingles: np.ndarray) -> list[int]:
    """The keys of a set; the empty one has none."""
    import xxhash

    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 4_096):
        part = shingles[None, at : at + 4_096] * _FACTORS[:, None] + _SHIFTS[:, None]
        least = np.minimum(least, part.min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are at least as similar as ``SHARE``."""
    up, down = SHARE
    if min(len(a), len(b)) * down < max(len(a), len(b)) * up:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * down >= (len(a) + len(b) - both) * up


def set_print(text: Column) -> Column:
    """The name of a text's set."""

    @F.arrow_udf("long")
    @lean
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([print_of(shingles_of(t)) for t in texts.to_pylist()], pa.int64())

    return prints(text)


def signatures(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``print``, fingerprint (``bits``), ``bands`` and ``shingles`` per row, written once."""
    small_batches(documents.sparkSession)

    @lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        for batch in batches:
            held, size, start = [], 0, 0
            for at in range(batch.num_rows):
                shingles = shingles_of(batch.column(1)[at].as_py())
                held.append((print_of(shingles), simhash.majority(shingles), bands_of(shingles), shingles.tobytes()))
                size += shingles.nbytes
                if size > HELD or at + 1 == batch.num_rows:
                    arrays = [pa.array(v, k) for v, k in zip(zip(*held), kinds)]
                    ids = batch.column(0).slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", "print", "bits", "bands", "shingles"])
                    held, size, start = [], 0, at + 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("t"))
    return stored(rows.mapInArrow(sign, "doc_id long, print long, bits long, bands array<long>, shingles binary"), "sets")


@lean
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between rows of a block that are not connected yet; a block's rows arrive one after the other."""

    def links(block: list[tuple]) -> pa.RecordBatch:
        block.sort(key=lambda row: len(row[2]))
        sets = [np.frombuffer(s, np.uint64) for _, _, s in block]
        label = np.array([root for _, root, _ in block])
        sizes = np.array([len(s) for s in sets])
        a, b = [], []
        for i in range(len(block)):
            stop = int(np.searchsorted(sizes * SHARE[0], sizes[i] * SHARE[1], "right"))
            for j in range(i + 1, stop):
                if label[i] != label[j] and alike(sets[i], sets[j]):
                    a.append(block[i][0])
                    b.append(block[j][0])
                    label[label == label[j]] = label[i]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key, block = None, []
    for batch in batches:
        for *at, name, root, shingles in zip(*(c.to_pylist() for c in batch.columns)):
            if at != key and block:
                yield links(block)
                block = []
            key = at
            block.append((name, root, shingles))
    if block:
        yield links(block)


def anchor_pairs(sets: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct prints that meet at an anchor: they connect all fingerprints within 3 bits."""
    known = stored(sets.select("print", "bits").dropDuplicates(["print"]), "bits")
    least = stored(known.groupBy("bits").agg(F.min("print").alias("least")), "least")
    links = simhash.near_links(least.select(F.col("bits").alias("print")))
    across = links.join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b").select("x", "y")
    within = known.join(least, "bits").where("print <> least").select("least", "print")
    return stored(across.unionAll(within).toDF("a", "b"), "met")


def near_links(sets: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct prints that connect all similar ones."""
    met = anchor_pairs(sets)
    spread = sets.select("print", "bands").dropDuplicates(["print"]).select("print", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.min("print").alias("least"), F.count("*").alias("n")).where("n > 1")
    spread = stored(join_counted(spread, stored(shared, "shared"), "band", "inner"), "spread")
    due = spread.select("print").unionAll(met.select("a")).unionAll(met.select("b"))
    named = stored(rows_of(sets.select("print", "shingles"), due, "print").dropDuplicates(["print"]), "named")

    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    def checked(pairs: DataFrame) -> DataFrame:
        rows = pairs.join(named.toDF("a", "x"), "a").join(named.toDF("b", "y"), "b")
        return rows.where(similar("x", "y")).select("a", "b")

    met = stored(checked(met), "linked")
    roots = stored(components(met), "met_roots")
    stars = spread.where("print <> least").select(F.col("least").alias("a"), F.col("print").alias("b")).distinct()
    # the anchors have connected many of these
    stars = stars.join(roots.toDF("a", "x"), "a", "left").join(roots.toDF("b", "y"), "b", "left")
    stars = checked(stars.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")).unionAll(met)
    stars = stored(stars, "stars")
    roots = stored(components(stars).select(F.col("node").alias("print"), "root"), "roots")
    spread = spread.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    # a key of two rows has had its only pair checked
    split = spread.where("n > 2").groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    split = stored(split.where("low <> high").select("band"), "split")
    own = F.pmod(F.xxhash64("print"), F.col("g")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda i: F.struct(F.least(own, i).alias("x"), F.greatest(own, i).alias("y")))
    rows = join_counted(spread, split, "band", "left_semi").withColumn("g", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.select("band", "print", "root", F.explode(cells).alias("c")).select("band", "c.x", "c.y", "print", "root")
    rows = rows.join(named, "print").select("band", "x", "y", "print", "root", "shingles")
    rows = rows.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
    return stars.unionAll(rows.mapInArrow(_compare, "a long, b long")).distinct()


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` without all but one row of each component: the one of the smallest id."""
    sets = signatures(documents)
    classes = simhash.near_duplicates(sets, near_links(sets))
    return simhash.keep_least(documents, sets.select("doc_id", "print"), classes, set_print)
