"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as their lower-case words joined by one space. An item of ``m``
characters may differ in ``k = floor(ERRORS * m)`` edits; it is cut into ``k + 1`` pieces, and an
occurrence within ``k`` edits holds one of them unchanged. One automaton finds every exact piece
in a document; the place of a piece fixes a window, windows that overlap are merged, and Myers'
bit-parallel algorithm takes the least edit distance of the whole item within the window.

Benchmark items are a stated query set: they are read in blocks of at most ``BLOCK_BYTES``, each
searched in all documents. Documents are never shuffled. Items of fewer than ``MIN_WORDS`` words
may not differ at all and match whole words only, or part of a common word would be a leak. Null
items and items without words match nothing, nor do null and empty texts. Empty tables of either
kind give no matches; repeated documents each get theirs, repeated items count once. Items of the same text are all reported. A null item id is reported as null.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fresh, lean, small_batches, text_of

#: Edits allowed per character of an item.
ERRORS = 0.05
#: Items of fewer words must occur exactly, from word bound to word bound.
MIN_WORDS = 5
BLOCK_BYTES = 8 << 20

WORD = re.compile(r"[^\W_]+")
MATCHES = "array<struct<item_id:bigint,distance:int>>"


def plain(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def least_distance(pattern: dict[str, int], m: int, text: str, most: int) -> int:
    """The least edit distance of a pattern to any part of ``text``, or ``most + 1``.

    ``pattern`` has the pattern's positions of each character as bits (Myers 1999, with the carry
    of Hyyrö). Stops at distance 0.
    """
    last, ones = 1 << (m - 1), (1 << m) - 1
    up, down, score, best = ones, 0, m, most + 1
    for c in text:
        eq = pattern.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        rise = (down | ~(diagonal | up)) & ones
        fall = up & diagonal
        score += bool(rise & last) - bool(fall & last)
        rise = rise << 1 & ones  # a match may begin anywhere: no cost is carried in
        fall = fall << 1 & ones
        up = (fall | ~(vertical | rise)) & ones
        down = rise & vertical
        if score < best:
            best = score
            if not best:
                break
    return best


class Items:
    """A block of items with the automaton of their pieces."""

    def __init__(self, items: list[tuple[int | None, str]], errors: float):
        import ahocorasick

        self.items, pieces = [], defaultdict(list)
        for item_id, text in items:
            short = text.count(" ") + 1 < MIN_WORDS
            m, k = len(text), 0 if short else int(errors * len(text))
            bits: dict[str, int] = defaultdict(int)
            for i, c in enumerate(text):
                bits[c] |= 1 << i
            for j in range(k + 1):
                start, end = j * m // (k + 1), (j + 1) * m // (k + 1)
                pieces[text[start:end]].append((len(self.items), start))
            self.items.append((item_id, text, m, k, short, dict(bits)))
        self.finder = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.finder.add_word(piece, (len(piece), places))
        self.finder.make_automaton()

    def matches(self, text: str) -> list[dict]:
        starts = defaultdict(set)
        for end, (length, places) in self.finder.iter(text):
            for item, offset in places:
                starts[item].add(end + 1 - length - offset)
        found = []
        for item, at in sorted(starts.items()):
            item_id, whole, m, k, short, bits = self.items[item]
            best = k + 1
            if short:
                ends = (" ", "")  # what a match may have on either side
                if any(text[s - 1 : s] in ends and text[s + m : s + m + 1] in ends for s in at):
                    best = 0
            elif any(s >= 0 and text.startswith(whole, s) for s in at):
                best = 0
            else:
                for low, high in windows(sorted(at), m, k):
                    best = min(best, least_distance(bits, m, text[max(low, 0) : high], k))
                    if not best:
                        break
            if best <= k:
                found.append({"item_id": item_id, "distance": best})
        return found


def windows(starts: list[int], m: int, k: int) -> Iterator[tuple[int, int]]:
    """Ranges that hold every occurrence within ``k`` edits of one of the starts, merged."""
    low = high = None
    for s in starts:
        if high is not None and s - k <= high:
            high = s + m + k
        else:
            if high is not None:
                yield low, high
            low, high = s - k, s + m + k
    if high is not None:
        yield low, high


def _finder(items: list[tuple[int | None, str]], errors: float):
    @F.arrow_udf(MATCHES)
    @lean
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Items(items, errors)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))
        for texts in batches:
            yield pa.array([block.matches(plain(t)) for t in texts.to_pylist()], kind)

    return find


def leaks(documents: DataFrame, benchmark: DataFrame, out: str = "matches", errors: float = ERRORS) -> DataFrame:
    """``documents`` with column ``out``: the items each holds, by item, with the least distance."""
    small_batches(documents.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    items = items.where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    found = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        rows = sorted({(r.item_id, plain(r.text)) for r in part}, key=repr)
        rows = [r for r in rows if r[1]]
        if rows:
            found.append(_finder(rows, errors)(text_of("text")))
    empty = F.array().cast(MATCHES)
    every = F.concat(*found) if len(found) > 1 else found[0] if found else empty
    return documents.withColumn(out, F.array_sort(every) if len(found) > 1 else every)


def remove_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    out = fresh(documents, "matches")
    return leaks(documents, benchmark, out).where(F.size(out) == 0).drop(out)
