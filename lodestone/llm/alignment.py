"""Alignment of the tokens that two tokenizers give a text.

Tokenizer A is a byte-level BPE one of the tokenizers library, B a sentencepiece model with byte
fallback; A reads a blank and the text, B puts the blank in front by itself. The places where tokens
of both end cut a text into groups, and every A token of a group is linked with every B token of it.

Coarse cuts come from the libraries' own character spans: A's offsets and the spans of B's proto,
where exactly one token of each side ends and the next one begins. Within a coarse group that holds
characters of several bytes, tokens may be parts of characters (A cuts them anywhere, B falls back
to bytes); such groups are cut further by the decoded bytes of their tokens. In all others a
character is a byte and the spans say all; where that holds for whole segments, the spans are the
sums of the decoded tokens' sizes, and the libraries need not make any.

Both tokenizers part before a blank that follows another character: no piece of B holds a blank
behind another character, and A's word pattern ends there. The segments in between are aligned once
and remembered, so texts of any length need the memory of their own segments only. Segments not met
before are put together from units: both also part before a line break between two other characters
and, if no piece of B holds both, between a Latin letter and a sign.

A text's distinct pairs are stored packed, then counted over all documents. Pairs with at least ``PAIR_SHARE`` of all
(document, pair) rows, so at most ``1 / PAIR_SHARE``, are looked up in the tasks; the others are joined
by shuffle, where no key has a larger share. The best count of an A id is one row per id of the
vocabulary.

Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: all
numbers are 0 and the digest is empty. Strings of special tokens are plain text. Repeated rows count
as documents of their own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import once_per_worker, small_batches, stored, text_of
from lodestone.llm.token_counts import SEGMENT, byte_of_character, vocabulary_path

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs of this share of all (document, pair) rows are looked up in every task instead of joined.
PAIR_SHARE = 1e-6
#: (document, pair) rows a task holds before it sends their counts on.
HELD = 2_000_000
#: Segments and units a worker remembers, in each of two generations, and the longest that it does.
REMEMBERED, REMEMBERED_LENGTH = 200_000, 64
#: Letters that A's word pattern knows as such, and signs that it parts from them.
LATIN, SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", ",.;:!?|%$&*#"
#: Short segments that are aligned as one text.
AT_ONCE = 2_000
#: Characters of the texts that are aligned at once, about.
TOGETHER = 1 << 20


# A segment's alignment: (n_a, n_b, n_groups, n_links, groups, pairs, times). ``groups`` is the text
# of the digest, ``pairs`` the linked ``a << 32 | b`` as 64-bit numbers, which may repeat, and ``times``
# how often each is linked as 32-bit numbers, both as bytes. A plain tuple, which the garbage collector need not track.
Aligned = tuple[int, int, int, int, str, bytes, bytes]


class Aligner:
    """Both tokenizers, from the contents of their files, and the segments aligned so far."""

    def __init__(self, files: tuple[str, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(files[0])
        self.first.encode_special_tokens = True
        self.first_ids = getattr(self.first, "encode_batch_fast", self.first.encode_batch)  # the former leaves the offsets out
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files[1])
        code = byte_of_character()
        self.first_bytes = {i: bytes(map(code.get, t)) for t, i in self.first.get_vocab(False).items()}
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(p[3:-1], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.first_sizes = np.array([len(self.first_bytes.get(i, b"")) for i in range(max(self.first_bytes) + 1)])
        self.second_sizes = np.array([len(x) for x in self.second_bytes])
        numbers = [str(i) for i in range(max(len(self.first_sizes), len(pieces)))]
        self.names = np.array([[n + sign for n in numbers] for sign in ",|;"], object)
        self.cuts = not any(" " in p.lstrip(" ") for p in (p.replace("▁", " ") for p in pieces))
        self.units = self.unit_ends(pieces)
        # releases of the library differ in whether spans count characters or bytes
        self.in_bytes = self.second.encode("é", return_type="proto").pieces[-1].end == 2
        self.known: dict[str, Aligned | tuple[()]] = {}  # empty: not given back byte by byte
        self.older: dict[str, Aligned | tuple[()]] = {}

    def unit_ends(self, pieces: list[str]) -> re.Pattern:
        """Matches the empty places inside segments where both tokenizers part."""
        inside = set(re.findall(rf"(?<=[{LATIN}])[{re.escape(SIGNS)}]", "\0".join(pieces)))
        signs = re.escape("".join(c for c in SIGNS if c not in inside))
        places = [r"(?<=\S)(?=\n\S)"] * (not any("\n" in p for p in pieces)) + [rf"(?<=[{LATIN}])(?=[{signs}])"] * bool(signs)
        return re.compile("|".join(places) if self.cuts and places else r"(?!)")

    def segments(self, text: str) -> list[str]:
        """The parts of a blank and the text, each with a blank in front."""
        parts = SEGMENT.findall(" " + text) if self.cuts else [" " + text]
        if len(parts) > 1 and parts[-1] == " ":  # B puts no blank in front of nothing
            parts[-2:] = [parts[-2] + " "]
        return parts

    def align(self, texts: list[str]) -> Iterator[list[Aligned] | None]:
        """Per text its segments' alignments; None if it has no tokens."""
        cut = [self.segments(t) if t else [] for t in texts]
        held = [list(map(self.known.get, parts)) for parts in cut]
        met = {s for parts, found in zip(cut, held) if None in found for s, a in zip(parts, found) if a is None}
        fresh = {s: self.older[s] for s in met & self.older.keys()}
        met.difference_update(fresh)
        fresh |= {s: a or () for s, a in self.solve(list(met)).items()}
        for parts, found in zip(cut, held):
            if None in found:
                found = [fresh[s] if a is None else a for s, a in zip(parts, found)]
            yield found if found and all(found) else None
        if len(self.known) + len(fresh) > REMEMBERED:  # those not met again for as many others are forgotten
            self.older, self.known = self.known, {}
        self.known |= {s: a for s, a in fresh.items() if len(s) <= REMEMBERED_LENGTH}

    def solve(self, segments: list[str]) -> dict[str, Aligned | None]:
        """Short segments are put together from their units; longer ones and those that end with white space are aligned alone."""
        single, units, rest, cut = set(), {}, [], self.units.split
        for s in segments:
            if len(s) > REMEMBERED_LENGTH or s[-1].isspace():
                rest.append(s)
            elif s[1:].isalpha() or len(parts := cut(s)) == 1:
                single.add(s)
            else:
                units[s] = parts
        met, held = set().union(*units.values()) - single, {}
        for some in (self.known, self.older):
            found = {u: some[u] for u in met & some.keys()}
            met.difference_update(found)
            held |= found
        solved = self.solve_units([*single, *met])
        held |= {u: solved.pop(u) or () for u in met}
        self.known |= held
        held |= solved
        for s, parts in units.items():
            found = list(map(held.__getitem__, parts))
            solved[s] = reduce(joined, found) if all(found) else None
        return solved | {s: self.alone(s) for s in rest}

    def solve_units(self, together: list[str]) -> dict[str, Aligned | None]:
        """Units are aligned many at once, as one text; those without a blank in front stand behind a letter."""
        solved: dict[str, Aligned | None] = {}
        plain = [s for s in together if s.isascii()]
        for alike in (plain, [s for s in together if not s.isascii()] if len(plain) < len(together) else []):
            for start in range(0, len(alike), AT_ONCE):
                some = [p for u in alike[start : start + AT_ONCE] for p in ((u,) if u[0] == " " else (" a", u))]
                solved.update(zip(some, self.many(some)))
        if " a" not in together:
            solved.pop(" a", None)
        return solved

    def alone(self, segment: str) -> Aligned | None:
        first = self.first.encode(segment, add_special_tokens=False)
        return self.segment(segment, first, self.second.encode(segment[1:], return_type="proto"))

    def many(self, segments: list[str]) -> list[Aligned | None]:
        """``segment`` of many at once: one after the other they are a text that both tokenizers part between them."""
        text = "".join(segments)
        data = text.encode()
        plain = len(data) == len(text)  # a character is a byte: the decoded bytes are the spans
        if plain:
            first = self.first_ids([text], add_special_tokens=False)[0]
            ids_a, ids_b = first.ids, self.second.encode(text[1:], out_type=int)
        else:
            first = self.first.encode(text, add_special_tokens=False)
            pieces = [(p.id, p.begin, p.end) for p in self.second.encode(text[1:], return_type="proto").pieces]
            ids_a, ids_b = first.ids, [i for i, _, _ in pieces]
        a, b = np.array(ids_a), np.array(ids_b)
        bytes_a, bytes_b = map(self.first_bytes.__getitem__, ids_a), map(self.second_bytes.__getitem__, ids_b)
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            if len(segments) == 1:
                return [None]
            half = len(segments) // 2
            half += segments[half][0] != " "
            if half == len(segments):
                return self.many(segments[:1]) + [None]
            return self.many(segments[:half]) + self.many(segments[half:])
        decoded = np.cumsum(self.first_sizes[a]), np.cumsum(self.second_sizes[b])
        ends = decoded if plain else self.ends(data, first.offsets, pieces, decoded)
        cuts = np.intersect1d(*ends, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends[0]), np.searchsorted(cuts, ends[1])
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        lengths = [len(s) for s in segments] if len(data) == len(text) else [len(s.encode()) for s in segments]
        place = np.searchsorted(np.cumsum(lengths), cuts)  # the segment of each group
        # links
        times = n_b[group_a]
        before = np.repeat(np.cumsum(times) - times, times)
        partner = np.repeat((np.cumsum(n_b) - n_b)[group_a], times) + np.arange(times.sum()) - before
        pairs, where = np.repeat(a, times) << 32 | b[partner], np.repeat(place[group_a], times)
        often = np.ones(len(pairs), np.int32)  # repeated ones are added up with the rest of the text
        # names: A ids of a group, then its B ids
        last_a, last_b = (np.append(np.diff(g) != 0, True) for g in (group_a, group_b))
        parts = np.concatenate([self.names[np.where(last_a, 1, 0), a], self.names[np.where(last_b, 2, 0), b]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        parts = parts[order].tolist()
        m = range(len(segments) + 1)
        total = [np.bincount(place, w, minlength=len(segments)).astype(np.int64).tolist() for w in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)]
        part_at = np.concatenate([[0], np.cumsum(np.add(total[0], total[1]))]).tolist()
        pair_at = np.searchsorted(where, m).tolist()
        pair_bytes, time_bytes, out = pairs.tobytes(), often.tobytes(), []
        for i, numbers in enumerate(zip(*total)):
            x, y = pair_at[i], pair_at[i + 1]
            names = "".join(parts[part_at[i] : part_at[i + 1]])[:-1]
            out.append((*numbers, names, pair_bytes[8 * x : 8 * y], time_bytes[4 * x : 4 * y]))
        return out

    def ends(self, data: bytes, offsets: list, pieces: list[tuple[int, int, int]], decoded: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """The bytes where the tokens of both end, from their spans and, where these are too coarse, their decoded bytes."""
        starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        byte_of = np.append(starts, len(data))
        spans_a = byte_of[np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)]
        spans_b = np.array(pieces)[:, 1:] + 1
        spans_b[0, 0] = 0
        if not self.in_bytes:
            spans_b = byte_of[spans_b]
        aligned = np.zeros(len(data) + 1, bool)
        aligned[byte_of] = True
        coarse = np.intersect1d(lone(spans_a), lone(spans_b), assume_unique=True)
        coarse = coarse[aligned[coarse]]
        if not len(coarse) or coarse[-1] < len(data):
            coarse = np.append(coarse, len(data))
        # within coarse groups of characters of several bytes the decoded bytes decide
        wide = np.diff(np.searchsorted(byte_of, np.concatenate([[0], coarse]))) != np.diff(coarse, prepend=0)
        return [np.where(wide[np.searchsorted(coarse, d)], d, spans[:, 1]) for spans, d in ((spans_a, decoded[0]), (spans_b, decoded[1]))]

    def segment(self, text: str, first, second) -> Aligned | None:
        a, ends_a = first.ids, [end for _, end in first.offsets]
        pieces = second.pieces  # spans are of the text behind the blank
        b, ends_b = [p.id for p in pieces], [p.end + 1 for p in pieces]
        bytes_a, bytes_b = [self.first_bytes[i] for i in a], [self.second_bytes[i] for i in b]
        data = text.encode()
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            return None
        if len(data) == len(text):  # a character is a byte: the spans say all
            groups = meeting(a, ends_a, b, ends_b)
        else:
            if self.in_bytes:
                places = [i for i, c in enumerate(text) for _ in c.encode()] + [len(text)]
                ends_b = [places[end] for end in ends_b]
            begins_b = [0] + [min(e, places[p.begin + 1] if self.in_bytes else p.begin + 1) for p, e in zip(pieces[1:], ends_b[1:])]
            lone_a, lone_b = lone_ends(first.offsets), lone_ends(list(zip(begins_b, ends_b)))
            groups, i, j, at = [], 0, 0, 0
            for end in [e for e in lone_a if e in lone_b and e < len(text)] + [len(text)]:
                stop_a, stop_b = (lone_a[end], lone_b[end]) if end < len(text) else (len(a), len(b))
                if stop_a - i == 1 or stop_b - j == 1:
                    groups.append((a[i:stop_a], b[j:stop_b]))
                elif text[at:end].isascii():
                    groups += meeting(a[i:stop_a], ends_a[i:stop_a], b[j:stop_b], ends_b[j:stop_b])
                else:
                    sizes = (np.cumsum([len(x) for x in some]).tolist() for some in (bytes_a[i:stop_a], bytes_b[j:stop_b]))
                    groups += meeting(a[i:stop_a], next(sizes), b[j:stop_b], next(sizes))
                i, j, at = stop_a, stop_b, end
        names = ";".join([f"{x[0]}|{y[0]}" if len(x) == len(y) == 1 else ",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups])
        pairs, times = links(groups)
        n_links = sum([len(x) * len(y) for x, y in groups])
        return len(a), len(b), len(groups), n_links, names, pairs.tobytes(), times.tobytes()


def joined(a: Aligned, b: Aligned) -> Aligned:
    """The alignment of two parts one after the other."""
    return a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3], f"{a[4]};{b[4]}", a[5] + b[5], a[6] + b[6]


def lone(spans: np.ndarray) -> np.ndarray:
    """``lone_ends`` of spans as an array."""
    begins, ends = spans[:, 0], spans[:, 1]
    after = np.append(begins[1:], ends[-1])
    apart = (ends == np.maximum.accumulate(ends)) & (np.minimum.accumulate(after[::-1])[::-1] >= ends)
    single = np.diff(ends, prepend=-1) != 0
    single[:-1] &= single[1:]
    return ends[apart & single]


def lone_ends(spans: list[tuple[int, int]]) -> dict[int, int]:
    """The characters at which exactly one token ends and none goes on, and the number of tokens up to it."""
    out, seen, reach = {}, -1, 0
    for i, (begin, end) in enumerate(spans):
        if begin < reach or end == seen:
            out.pop(reach, None)
        if end > reach:
            out[end] = i + 1
        seen, reach = end, max(reach, end)
    return out


def meeting(a: list[int], ends_a: list[int], b: list[int], ends_b: list[int]) -> list[tuple[list[int], list[int]]]:
    """Cut two lists of ids where tokens of both end."""
    out, i, j, start_i, start_j = [], 0, 0, 0, 0
    while i < len(a):
        if ends_a[i] == ends_b[j]:
            i, j = i + 1, j + 1
            out.append((a[start_i:i], b[start_j:j]))
            start_i, start_j = i, j
        elif ends_a[i] < ends_b[j]:
            i += 1
        else:
            j += 1
    return out


def links(groups: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of linked ids and how often each is linked."""
    found, large = [], []
    for a, b in groups:
        if len(a) * len(b) > 1_000:
            (x, n), (y, m) = (np.unique(np.array(ids, np.int64), return_counts=True) for ids in (a, b))
            large.append(((x[:, None] << 32 | y[None, :]).ravel(), (n[:, None] * m[None, :]).ravel()))
        else:
            found += [x << 32 | y for x in a for y in b]
    if not large and len(set(found)) == len(found):
        return np.array(found, np.int64), np.ones(len(found), np.int32)
    pairs, times = np.array(found, np.int64), np.ones(len(found), np.int64)
    pairs, times = summed(np.concatenate([pairs, *(p for p, _ in large)]), np.concatenate([times, *(t for _, t in large)]))
    return pairs, times.astype(np.int32)


def summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and the sums of their numbers."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[starts], np.add.reduceat(times[order].astype(np.int64), starts) if len(pairs) else np.zeros(0, np.int64)


def of_text(pairs: Iterable[bytes], times: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a text and how often each is linked, from those of its segments."""
    return summed(np.frombuffer(b"".join(pairs), np.int64), np.frombuffer(b"".join(times), np.int32))


def batches_of(texts: list[str | None], size: int = TOGETHER) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters."""
    some, held = [], 0
    for text in texts:
        some.append(text or "")
        held += len(some[-1])
        if held > size:
            yield some
            some, held = [], 0
    if some:
        yield some


def packed(values: np.ndarray) -> bytes:
    steps = values.astype(np.int64)
    steps[1:] -= values[:-1]
    return pa.compress(steps.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(data, 8 * size, "zstd"), np.int64))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair`` and ``n``, the rows that hold it, of packed ``pairs`` and their number ``size``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            kinds, n = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(kinds), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(kinds[i : i + 100_000]), pa.array(n[i : i + 100_000], pa.int64())], ["pair", "n"])

        for batch in batches:
            for data, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n:
                    held.append(unpacked(data, n))
                    size += n
                if size > HELD:
                    yield from sent()
                    held, size = [], 0
        if held:
            yield from sent()

    counts = rows.select("pairs", "size").mapInArrow(count, "pair long, n long")
    return counts.groupBy("pair").agg(F.sum("n").alias("n"))


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_texts(documents: DataFrame, aligner) -> DataFrame:
    """Per row ``doc_id``, its numbers, the digest of its groups, and its packed pairs and how often each is linked."""
    kind = pa.struct([(c, pa.int64()) for c in NUMBERS] + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()), ("size", pa.int32())])
    nothing = dict.fromkeys(NUMBERS, 0) | {"groups_sha256": "", "size": 0}

    @F.arrow_udf(f"struct<{','.join(f'{c}:bigint' for c in NUMBERS)},groups_sha256:string,pairs:binary,times:binary,size:int>")
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for some in batches_of(texts.to_pylist()):
                for found in aligner().align(some):
                    if not found:
                        out.append(nothing)
                        continue
                    *numbers, groups, pairs, times = zip(*found)
                    pairs, times = of_text(pairs, times)
                    row = dict(zip(NUMBERS, map(sum, numbers)))
                    row["groups_sha256"] = hashlib.sha256(";".join(groups).encode()).hexdigest()
                    out.append(row | {"pairs": packed(pairs), "times": packed(times), "size": len(pairs)})
            yield pa.array(out, kind)

    return documents.select("doc_id", aligned(text_of("text")).alias("s")).select("doc_id", "s.*")


def align(documents: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Per row ``doc_id``, token, group and link numbers, how common its links are, and a digest of its groups.

    ``first`` and ``second`` are the vocabulary files, read at the driver.
    """
    spark = documents.sparkSession
    small_batches(spark)
    with open(first or vocabulary_path(FIRST), encoding="utf-8") as file:
        spec = file.read()
    with open(second or vocabulary_path(SECOND), "rb") as file:
        model = file.read()
    rows = stored(aligned_texts(documents, once_per_worker(spark, (spec, model), Aligner)), "aligned")
    counts = stored(pair_counts(rows), "pairs")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("best"))
    # one row per id of the first vocabulary at most
    counts = counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(best), "a")
    counts = stored(counts.select("pair", "n", (F.col("n") == F.col("best")).alias("best")), "counts")
    frequent = F.lit(PAIR_SHARE * float(counts.agg(F.sum("n")).first()[0] or 0))
    table = counts.where(F.col("n") >= frequent).toArrow()
    keys, n, is_best = (table.column(i).to_numpy() for i in range(3))
    order = np.argsort(keys)
    lookup = once_per_worker(spark, (keys[order], n[order], is_best[order].astype(bool)), lambda columns: columns)
    kind = pa.struct([("n_best", pa.int64()), ("count_sum", pa.int64()), ("rest", pa.list_(pa.int64())), ("often", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint,rest:array<bigint>,often:array<bigint>>")
    def scored(pairs: pa.Array, times: pa.Array, size: pa.Array) -> pa.Array:
        out = []
        keys, n, is_best = lookup()
        for some, often, count in zip(pairs.to_pylist(), times.to_pylist(), size.to_pylist()):
            if not count:
                out.append({"n_best": 0, "count_sum": 0})
                continue
            some, often = unpacked(some, count), unpacked(often, count)
            at = np.searchsorted(keys, some)
            hit = at < len(keys)
            hit[hit] = keys[at[hit]] == some[hit]
            at, known = at[hit], often[hit]
            out.append({"n_best": known[is_best[at]].sum(), "count_sum": (known * n[at]).sum(), "rest": some[~hit], "often": often[~hit]})
        return pa.array(out, kind)

    rows = rows.withColumn("s", scored("pairs", "times", "size")).drop("pairs", "times", "size").withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.select("row", "doc_id", *NUMBERS, "groups_sha256", "s.*"), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rest", "often")).alias("r")).select("row", F.col("r.rest").alias("pair"), "r.often")
    rare = rare.join(counts.where(F.col("n") < frequent), "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("b"), F.sum(F.col("often") * F.col("n")).alias("c")]
    rows = rows.drop("rest", "often").join(rare.groupBy("row").agg(*sums), "row", "left")
    return rows.select(
        "doc_id",
        *NUMBERS,
        (F.col("n_best") + F.coalesce("b", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("c", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
