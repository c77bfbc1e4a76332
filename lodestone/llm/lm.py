"""Cross-entropy difference of two bigram models over one vocabulary.

All words and all bigrams of the corpus are known. The target model counts the documents labelled
good, the background model all documents; both have the same words, the same bigrams and the same
smoothing: ``P(b | a) = MIX * c(ab) / c(a) + (1 - MIX) * (c(b) + 1) / (n + V)``.
The loss of a token is ``-ln P``; a document's score is the mean over its tokens of target loss
minus background loss, so a lower one is closer to the target.

Words and bigrams are 64-bit hashes. Texts are cut into tokens once and stored in chunks, as
numbers into the chunk's own list of words. A chunk asks for the counts of its distinct bigrams, first
words and second words: it sends sorted keys and its own counts in packed slots, the tasks that hold
a slot add up what all chunks send, and the answer is what others have beside a chunk's own counts, which for a
bigram of one chunk is nothing. So a rare bigram costs its key once, a frequent one once per
chunk, and no key has a task of its own.

Null and empty texts have no tokens and null losses. Repeated rows count as often as they occur.
Labels without document teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import lean, parts, small_batches, stored, text_of
from lodestone.operators.topk import join_counted

MIX = 0.7
#: Tokens of a chunk, about.
HELD = 2_000_000
#: The word before the first one.
START = 1

TOKEN = re.compile(r"\w+|[^\w\s]+")

ENTRY = "chunk long, slot long, size long, keys binary, target binary, background binary"
ANSWER = "chunk long, slot long, size long, words long, target binary, background binary"

U = np.uint64
ODD = U(1)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def with_target(documents: DataFrame, good: DataFrame) -> DataFrame:
    """``doc_id``, ``target``, whether a document is of the target, and its text."""
    ids = good.select(F.col("doc_id").alias("good_id")).where("good_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    rows = documents.select("doc_id", F.col("doc_id").cast("long").alias("good_id"), text_of("text").alias("text"))
    return join_counted(rows, ids, "good_id", "left").select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")


class Numbers(dict):
    """Words numbered in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def squeezed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, the lowest bytes of all of them first: bytes that are mostly zero take no room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def chunks(rows: DataFrame) -> DataFrame:
    """Consecutive documents with their tokens as numbers into ``words``, stored."""
    import xxhash

    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["ids", "n", "n_target", "n_words", "sizes", "good", "words", "tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, good, found, known, held = [], [], [], [], Numbers(), 0

        def sent() -> pa.RecordBatch:
            numbers = np.concatenate(found)
            words = np.array([xxhash.xxh64_intdigest(w, 0) for w in known], U)
            counts = np.array(sizes, np.int64)
            of_target = np.array(good, bool)
            long = [pa.array([x], pa.int64()) for x in (len(numbers), int(counts[of_target].sum()), len(words))]
            packed = [counts.tobytes(), of_target.tobytes(), words.tobytes(), squeezed(numbers)]
            listed = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(ids))
            return pa.RecordBatch.from_arrays([listed, *long, *(pa.array([x], pa.binary()) for x in packed)], names)

        for batch in batches:
            start = 0
            for at, (of_target, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()), 1):
                found.append(np.array([known[w] for w in tokens(text)], np.uint32))
                sizes.append(len(found[-1]))
                good.append(of_target)
                held += sizes[-1] + 1
                if held > HELD:
                    ids.append(batch.column(0).slice(start, at - start))
                    yield sent()
                    ids, sizes, good, found, known, held, start = [], [], [], [], Numbers(), 0, at
            ids.append(batch.column(0).slice(start))
        if sizes:
            yield sent()

    shape = f"ids array<{kind}>, n long, n_target long, n_words long, sizes binary, good binary, words binary, tokens binary"
    found = rows.select("doc_id", "target", "text").mapInArrow(lean(cut), shape)
    return stored(found.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Bigrams:
    """The bigrams of a chunk, the one with a document's first token included.

    ``pair`` is the place of every token's bigram in the distinct ones, and ``first`` and ``second`` the words
    of these. ``keys`` are sorted: those of the bigrams, of the words as first and of the words as
    second ones, which alone are odd. ``place`` leads from that order to the sorted one.
    """

    def __init__(self, row: dict):
        words = np.append(np.frombuffer(row["words"], U), U(START))
        numbers = unsqueezed(row["tokens"], row["n"], np.uint32).astype(np.int64)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.good = np.repeat(np.frombuffer(row["good"], bool), self.sizes)
        before = np.empty_like(numbers)
        before[1:] = numbers[:-1]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = len(words) - 1
        kinds, self.pair = np.unique(before * len(words) + numbers, return_inverse=True)
        self.first, self.second = np.divmod(kinds, len(words))
        keys = [
            mix(words[self.first] * U(0x9E3779B97F4A7C15) ^ words[self.second]) & ~ODD,
            mix(words ^ U(0xC2B2AE3D27D4EB4F)) & ~ODD,
            mix(words ^ U(0x165667B19E3779F9)) | ODD,
        ]
        keys, self.n_pairs, self.n_words = np.concatenate(keys), len(kinds), len(words)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))
        self.own = [self.counts(good)[order] for good in (self.good, slice(None))]

    def counts(self, of) -> np.ndarray:
        pairs = np.bincount(self.pair[of], minlength=self.n_pairs)
        words = [np.bincount(x, pairs, self.n_words).astype(np.int64) for x in (self.first, self.second)]
        return np.concatenate([pairs, *words])

    def asked(self) -> np.ndarray:
        """Which keys are sent: not those of words that are never first, or never second."""
        return self.own[1] > 0


def slots_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal ranges of keys begins, and the end of the last one."""
    return np.searchsorted(keys, np.array([(i << 64) // n for i in range(n)], U)).tolist() + [len(keys)]


def asked(batches: Iterator[pa.RecordBatch], n_slots: int) -> Iterator[pa.RecordBatch]:
    """What each chunk asks; see ``ENTRY``."""
    for batch in batches:
        for row in batch.to_pylist():
            if not row["n"]:
                continue
            found = Bigrams(row)
            sent = found.asked()
            keys, own = found.keys[sent], [x[sent].astype(np.uint32) for x in found.own]
            edges, out = slots_of(keys, n_slots), []
            for slot, (i, j) in enumerate(zip(edges, edges[1:])):
                if i < j:
                    packed = [squeezed(np.diff(keys[i:j], prepend=U(0))), *(squeezed(x[i:j]) for x in own)]
                    out.append((row["chunk"], slot, j - i, *packed))
            yield records(out, ENTRY)


def records(rows: list[tuple], shape: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in shape.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [name for name, _ in fields])


def answered(table: pa.Table) -> pa.Table:
    """Add up what all chunks ask of one slot; the distinct second words are told with the first chunk's answer."""
    rows = table.to_pylist()
    sizes = [r["size"] for r in rows]
    keys = np.concatenate([np.cumsum(unsqueezed(r["keys"], r["size"], U), dtype=U) for r in rows])
    order = np.argsort(keys, kind="stable")  # merges what is sorted already
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    words = int((keys[order][new] & ODD).sum())
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    others = []
    for c in ("target", "background"):
        own = np.concatenate([unsqueezed(r[c], r["size"], np.uint32) for r in rows]).astype(np.int64)
        others.append(np.add.reduceat(own[order], np.flatnonzero(new))[place] - own)
    out = []
    for r, end, n in zip(rows, np.cumsum(sizes).tolist(), sizes):
        out.append((r["chunk"], r["slot"], n, 0 if out else words, *(squeezed(x[end - n : end]) for x in others)))
    return pa.Table.from_batches([records(out, ANSWER)])


def losses(row: dict, told: list[dict], known_words: int, totals: tuple[float, float]) -> pa.Table:
    """The mean losses of a chunk's documents."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    sums = np.zeros((2, len(sizes)))
    if row["n"]:
        found = Bigrams(row)
        sent, told = found.asked(), sorted(told, key=lambda r: r["slot"])
        whose = np.repeat(np.arange(len(sizes)), sizes)
        for model, (c, n) in enumerate(zip(("target", "background"), totals)):
            counts = found.own[model].copy()
            counts[sent] += np.concatenate([unsqueezed(r[c], r["size"], np.int64) for r in told])
            counts = counts[found.place]
            pairs, firsts, seconds = np.split(counts, [found.n_pairs, found.n_pairs + found.n_words])
            before = firsts[found.first]
            given = np.divide(pairs, before, out=np.zeros(len(pairs)), where=before > 0)
            own = (seconds[found.second] + 1.0) / (n + known_words + 2)
            loss = -np.log(MIX * given + (1 - MIX) * own)
            sums[model] = np.bincount(whose, loss[found.pair], len(sizes))
    empty = sizes == 0
    means = [pa.array(x / np.maximum(sizes, 1), pa.float64(), mask=empty) for x in sums]
    return pa.table([row["ids"], pa.array(sizes), *means], ["doc_id", "n_tokens", "target_loss", "background_loss"])


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score`` per row."""
    spark = documents.sparkSession
    small_batches(spark)
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    texts = chunks(with_target(documents, good))
    n, n_target = texts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0))).first()
    n_slots = max(parts(spark), -(-n // HELD))
    entries = texts.mapInArrow(lean(lambda batches: asked(batches, n_slots)), ENTRY)
    answers = stored(entries.groupBy("slot").applyInArrow(answered, ANSWER), "answers")
    known_words = answers.agg(F.sum("words")).first()[0] or 0

    def scored(rows: pa.Table, told: pa.Table) -> pa.Table:
        row = rows.drop_columns("ids").to_pylist()[0] | {"ids": rows["ids"].combine_chunks().values}
        return losses(row, told.to_pylist(), known_words, (float(n_target), float(n)))

    kind = documents.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_tokens long, target_loss double, background_loss double"
    rows = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, shape)
    return rows.withColumn("score", F.col("target_loss") - F.col("background_loss"))
