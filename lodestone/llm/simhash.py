"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. If two differ in at most 3, one of their halves differs in at most 1.
The low 31 bits of each half are covered by the codewords of the perfect Hamming code of length
31: every word lies within 1 of exactly one codeword, its home. A word within 1 of another lies
within 2 of the other's home, so each half is copied to every anchor within radius 1 + 1 = 2, at
most 16 of them, and at an anchor the fingerprints that have their home there are compared with
all that were copied there. No pair within 3 bits is missed.

Equal fingerprints are one row before that. An anchor with more than ``BLOCK`` rows is cut into a
grid of blocks, each compared in a task of its own, and an anchor sends on a spanning forest of
its links, never all pairs. Components come from alternating stars.

Null texts are empty texts; texts without words have fingerprint zero and link like any other.
Repeated rows and ids get one result row each. A null id is no component id: a component has the
smallest of its other ids, or null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fresh, lean, small_batches, stored, text_of
from lodestone.llm.components import components
from lodestone.operators.topk import join_counted, without_rows_of

SHINGLE = 3
THRESHOLD = 3
#: Rows of one anchor that are compared in one block.
BLOCK = 2_048


def fingerprint_of(text: str) -> int:
    """The 64-bit fingerprint, as a signed number."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, and space, \t to \r cut words
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], 42) for i, j in zip(starts, stops)], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of unsigned hashes, as a signed number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.arrow_udf("long")
    @lean
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint_of(t) for t in texts.to_pylist()], pa.int64())

    return prints(text)


def _flips() -> np.ndarray:
    """By syndrome: the flips that lead from a 31-bit word to the codewords within 2, the home first.

    The code's parity checks are the binary digits of the bit places 1 to 31. A codeword has no
    other within 2; its row is filled up with zeros.
    """
    out = np.zeros((32, 16), np.int64)
    for s in range(1, 32):
        out[s, 0] = 1 << (s - 1)
        pairs = [(a, a ^ s) for a in range(1, 32) if a < a ^ s and a != s]
        out[s, 1:] = [1 << (a - 1) | 1 << (b - 1) for a, b in pairs]
    return out


FLIPS = _flips()
CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For signed fingerprints: anchor keys, the place of the fingerprint, and whether it is its home."""
    keys, places, homes = [], [], []
    for half in (0, 1):
        low = (prints >> (32 * half)) & 0x7FFFFFFF
        syndrome = np.zeros(len(low), np.int64)
        for k, check in enumerate(CHECKS):
            syndrome |= (np.bitwise_count(low & check).astype(np.int64) & 1) << k
        ball = low[:, None] ^ FLIPS[syndrome]
        keep = np.ones(ball.shape, bool)
        keep[syndrome == 0, 1:] = False
        row, column = np.nonzero(keep)
        keys.append(ball[row, column] | half << 31)
        places.append(row)
        homes.append(column == 0)
    return np.concatenate(keys), np.concatenate(places), np.concatenate(homes)


@lean
def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), 4_096):
            part = prints[at : at + 4_096]
            keys, places, homes = anchors_of(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(part[places]), pa.array(homes)], ["anchor", "print", "home"]
            )


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed fingerprints. Of a signed number numpy counts the bits of its absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(prints: np.ndarray, homes: np.ndarray) -> tuple[list, list]:
    """Links of one block that join its home rows with all rows within the threshold, without cycles."""
    a, b = [], []
    label = np.arange(len(prints))
    for i in np.nonzero(homes)[0]:
        near = distances(prints, prints[i]) <= THRESHOLD
        near[i] = True
        met, first = np.unique(label[near], return_index=True)
        if len(met) > 1:
            ends = np.nonzero(near)[0][first]
            ends = ends[met != label[i]]
            a += [prints[i]] * len(ends)
            b += prints[ends].tolist()
            label[np.isin(label, met)] = met[0]
    return a, b


@lean
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within blocks; the rows of a block arrive one after the other."""
    left = None

    def links(table: pa.Table) -> pa.RecordBatch:
        block = [table.column(i).to_numpy() for i in range(3)]
        prints, homes = table.column(3).to_numpy(), table.column(4).to_numpy(zero_copy_only=False)
        change = np.zeros(len(prints), bool)
        change[:1] = True
        for c in block:
            change[1:] |= c[1:] != c[:-1]
        starts = np.nonzero(change)[0]
        sizes = np.diff([*starts, len(prints)])
        group = np.repeat(np.arange(len(starts)), sizes)
        held = np.bincount(group, homes, len(starts)).astype(np.int64)
        few = (sizes > 1) & (sizes * held <= 64)
        # small blocks: all pairs of a home row with a row of the block, at once
        home = np.nonzero(homes & few[group])[0]
        reach = sizes[group[home]]
        x = np.repeat(home, reach)
        y = np.repeat(starts[group[home]], reach) + np.arange(len(x)) - np.repeat(np.cumsum(reach) - reach, reach)
        near = (x != y) & (distances(prints[x], prints[y]) <= THRESHOLD)
        a, b = [prints[x[near]]], [prints[y[near]]]
        for g in np.nonzero((sizes > 1) & (held > 0) & ~few)[0]:
            at = slice(starts[g], starts[g] + sizes[g])
            more = forest(prints[at], homes[at])
            a.append(np.array(more[0], np.int64))
            b.append(np.array(more[1], np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch]).combine_chunks()
        if not table.num_rows:
            continue
        # hold the last block back: it may go on in the next batch
        same = np.ones(table.num_rows, bool)
        for i in range(3):
            c = table.column(i).to_numpy()
            same &= c == c[-1]
        cut = int(np.nonzero(~same)[0][-1]) + 1 if not same.all() else 0
        left = table.slice(cut)
        if cut:
            yield links(table.slice(0, cut))
    if left is not None and left.num_rows:
        yield links(left)


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``print``) that connect all within 3 bits."""
    spread = prints.mapInArrow(_replicate, "anchor long, print long, home boolean")
    sizes = spread.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    sizes = stored(sizes.select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("g")), "hot")
    hot = join_counted(spread, sizes, "anchor", "left")
    own = F.pmod(F.xxhash64("print"), F.col("g")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda i: i)
    grid = F.when(F.col("g").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("home"))))
    # a home row meets every block of copies, a copy every block of home rows
    as_home = F.transform(every, lambda i: F.struct(own.alias("x"), i.alias("y"), F.col("home")))
    as_copy = F.transform(every, lambda i: F.struct(i.alias("x"), own.alias("y"), F.lit(False).alias("home")))
    grid = grid.when(F.col("home"), F.concat(as_home, F.filter(as_copy, lambda s: s["x"] != own))).otherwise(as_copy)
    cells = hot.select("anchor", "print", F.explode(grid).alias("s"))
    cells = cells.select("anchor", F.col("s.x").alias("x"), F.col("s.y").alias("y"), "print", F.col("s.home").alias("home"))
    cells = cells.repartition("anchor", "x", "y").sortWithinPartitions("anchor", "x", "y")
    return cells.mapInArrow(_compare, "a long, b long").distinct()


def signatures(documents: DataFrame) -> DataFrame:
    """``doc_id`` and fingerprint (``print``) per row, written once."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("t"))
    return stored(rows.select("doc_id", fingerprint(F.col("t")).alias("print")), "prints")


def near_duplicates(prints: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Per fingerprint: ``print`` and ``component_id``, the smallest id reachable over links (``near_links``)."""
    groups = stored(prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "groups")
    links = near_links(groups.select("print")) if links is None else links
    linked = components(links).select(F.col("node").alias("print"), "root")
    groups = groups.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return stored(groups.join(least, "root").select("print", "root", "component_id"), "classes")


def simhash(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``print`` and ``component_id``."""
    prints = signatures(documents)
    return prints.join(near_duplicates(prints).drop("root"), "print", "left")


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` without all but one row of each component: the one of the smallest id.

    Rows that share the id and the component count as one; a null id counts as the largest.
    """
    prints = signatures(documents)
    return keep_least(documents, prints, near_duplicates(prints), fingerprint)


def keep_least(documents: DataFrame, prints: DataFrame, classes: DataFrame, print_of: Callable[[Column], Column]) -> DataFrame:
    """``keep_one`` by the ``classes`` of the ``prints`` that ``print_of`` gives a text."""
    member = prints.join(classes, "print")
    odd = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id")
    odd = stored(odd, "repeated")
    losers = stored(member.where("doc_id <> component_id").select("doc_id").distinct(), "losers")
    once = odd.isEmpty()
    if once:
        return without_rows_of(documents, losers, "doc_id")
    # ids that repeat do not name a row: those rows are told apart by their fingerprint
    name, root, least = (fresh(documents, n) for n in ("print", "root", "component_id"))
    known = odd.where("doc_id IS NOT NULL")
    plain = documents.where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti")
    plain = without_rows_of(plain, losers.join(known, "doc_id", "left_anti"), "doc_id")
    rest = documents.where("doc_id IS NULL").unionAll(documents.join(known, "doc_id", "left_semi").select(documents.columns))
    rest = rest.withColumn(name, print_of(text_of("text")))
    rest = rest.join(classes.toDF(name, root, least), name)
    rest = rest.where(F.col("doc_id").eqNullSafe(F.col(least))).dropDuplicates(["doc_id", root])
    return plain.select(documents.columns).unionAll(rest.select(documents.columns))
