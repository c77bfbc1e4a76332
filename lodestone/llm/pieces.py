"""SentencePiece encoding and decoding by a max-plus parallel scan.

The best segmentation of a text into pieces of a vocabulary is a longest path: the score of a path
is the sum of its pieces' scores. A giant text is split into chunks. The state at a chunk boundary
is how many characters before it the path has its last cut, fewer than the longest piece has; a
chunk is then a matrix, in (max, +), from the states at its start to those at its end. Matrices
are multiplied per block of chunks and blocks per text, which fixes the state at every boundary,
and each chunk is backtraced on its own. Where no piece holds two neighbouring characters (a
letter before a blank, a line break) every path has a cut; the segments in between are solved
once and remembered, and the matrix of a chunk reduces to its first and last segment.

The vocabulary is read from a model file at the driver and never trained. The public models at
hand were made by merging and order their pieces by rank, they hold no probabilities, so the score
of the piece of rank r is -ln(r + 2), Zipf's law, in whole numbers so that sums are exact. The ids
are therefore those of the best path, not those of the merging algorithm. A character without a
piece becomes its UTF-8 bytes. Blanks are the model's blank mark, a text gets one in front, and
decoding is the exact inverse. Paths of the same score: within a chunk the longest last piece wins.

Null and empty texts have no ids. Repeated giant texts are solved once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fresh, lean, small_batches, stored, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk; longer texts are scanned in parallel.
CHUNK = 65_536
#: Chunks multiplied in one task.
BLOCK = 256
SCALE = 1 << 16
UNKNOWN = 10
NEVER = -(1 << 60)
REMEMBERED = 100_000
#: Longest segment that is remembered, and the number of new ones solved together.
TOGETHER, AT_ONCE = 64, 10_000
#: Characters of the texts whose segments are held at once, about.
HELD = 1 << 19

IDS = pa.list_(pa.int32())


def vocabulary(path: str = MODEL) -> list[tuple[str, bool]]:
    """The pieces of a model by id, blanks for its blank mark, and whether each may be used in a path."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        usable = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        out.append((model.id_to_piece(i).replace("▁", " ") if usable else model.id_to_piece(i), usable))
    return out


class Lattice(dict):
    """The paths over a vocabulary; as a dict, the ids (32-bit, as bytes) and score of a segment's best path."""

    def __init__(self, pieces: list[tuple[str, bool]]):
        super().__init__()
        first = next(i for i, (_, usable) in enumerate(pieces) if usable)
        self.pieces = {p: (i, -round(SCALE * math.log(i - first + 2))) for i, (p, usable) in enumerate(pieces) if usable}
        #: Score and id of every beginning of a piece; one that is no piece itself scores NEVER.
        self.known = {p[:n]: (NEVER, None) for p in self.pieces for n in range(1, len(p))}
        self.known |= {p: (score, i) for p, (i, score) in self.pieces.items()}
        self.longest = max(map(len, self.pieces))
        self.unknown = -round(SCALE * (math.log(len(pieces)) + UNKNOWN))
        self.bytes = {int(p[3:-1], 16): i for i, (p, usable) in enumerate(pieces) if re.fullmatch("<0x[0-9A-F]{2}>", p) and not usable}
        self.segments = self.cutter()
        self.older: dict = {}
        # the beginnings of pieces as a tree: node 0 is empty, a step is (node, character)
        node = {"": 0} | {p: i for i, p in enumerate(self.known, 1)}
        steps = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in self.known])
        order = np.argsort(steps)
        self.steps, self.nodes = steps[order], order + 1
        self.scores = np.array([NEVER] + [score for score, _ in self.known.values()])
        self.ids = np.array([-1] + [-1 if i is None else i for _, i in self.known.values()])

    def cutter(self) -> re.Pattern:
        """Matches the segments between the places where every path has a cut.

        These lie before a blank, around a line break, and between a letter and those signs that
        follow a letter in no piece.
        """
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces):
            return re.compile(r"(?s).+")
        inside = {b for p in self.pieces for a, b in zip(p, p[1:]) if re.fullmatch(r"[^\W\d_]", a)}
        signs = re.escape("".join(c for c in ",.;:!?|%$&*#" if c not in inside)) or r"\n"
        rest = rf"[^ \n{signs}]*(?:(?<![^\W\d_])[{signs}][^ \n{signs}]*)*"
        return re.compile(rf"\n| +{rest}|[{signs}]{rest}|[^ \n{signs}]{rest}")

    def __missing__(self, segment: str) -> tuple[bytes, int]:
        made = self.older.get(segment) or self.path(segment)
        if len(segment) <= TOGETHER:
            if len(self) >= REMEMBERED:  # segments not met again for as many others are forgotten
                self.older = dict(self)
                self.clear()
            self[segment] = made
        return made

    def edges(self, text: str, start: int, end: int) -> Iterator[tuple[int, int, int | None]]:
        """Pieces that begin at ``start``: their end, score and id; None is the character's bytes."""
        for stop in range(start + 1, min(start + self.longest, end) + 1):
            found = self.known.get(text[start:stop])
            if found is None:
                break
            if found[1] is not None:
                yield stop, found[0], found[1]
        if start < end and text[start] not in self.pieces:
            yield start + 1, self.unknown, None

    def path(self, text: str, crossing: int = 0) -> tuple[bytes, int]:
        """Ids and score of the best path over a whole text whose first piece ends behind ``crossing``."""
        n, size, known = len(text), self.longest, self.known.get
        best, start, piece = [NEVER] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        best[0] = 0
        for i in range(n):
            here = best[i]
            if here == NEVER:
                continue
            first = i if i or not crossing else crossing
            for j in range(i + 1, min(i + size, n) + 1):
                found = known(text[i:j])
                if found is None:
                    break
                if here + found[0] > best[j] and j > first:
                    best[j], start[j], piece[j] = here + found[0], i, found[1]
            if text[i] not in self.pieces and here + self.unknown > best[i + 1] and i + 1 > first:
                best[i + 1], start[i + 1], piece[i + 1] = here + self.unknown, i, None
        out: list[int] = []
        while n:
            if piece[n] is not None:
                out.append(piece[n])
            else:
                out += self.spelled(text[start[n] : n])[::-1]
            n = start[n]
        return np.array(out[::-1], np.int32).tobytes(), best[-1]

    def remember(self, segments: set[str]) -> None:
        """Solve the segments not yet known together, in array steps."""
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        new = {s for s in segments.difference(self) if 0 < len(s) <= TOGETHER}
        met = new & self.older.keys()
        self.update({s: self.older[s] for s in met})
        new = list(new - met)
        for at in range(0, len(new), AT_ONCE):
            self.update(self.solved(new[at : at + AT_ONCE]))

    def solved(self, words: list[str]) -> Iterator[tuple[str, tuple[bytes, int]]]:
        """What ``path`` gives for each of many short texts."""
        sizes = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # position p of word w is place begin[w] + p; a word has one place more than characters
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        places = np.arange(len(chars)) + np.repeat(np.arange(len(words)), sizes)
        stops = np.repeat(begin + sizes, sizes)
        padded = np.zeros(len(chars) + len(words), np.int64)
        padded[places] = chars
        found, at, node = [], places, np.zeros(len(places), np.int64)
        for n in range(self.longest):
            step = node << 21 | padded[at + n]
            i = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            held = self.steps[i] == step
            at, stops, node = at[held], stops[held], self.nodes[i[held]]
            whole = self.ids[node] >= 0
            found.append((at[whole], at[whole] + n + 1, self.scores[node[whole]], self.ids[node[whole]]))
            if not n:  # characters without a piece
                single = np.zeros(len(padded), bool)
                single[at[whole]] = True
                lone = places[~single[places]]
                found.append((lone, lone + 1, np.full(len(lone), self.unknown), np.full(len(lone), -1)))
            at, stops, node = (x[at + n + 1 < stops] for x in (at, stops, node))
        start, stop, score, piece = map(np.concatenate, zip(*found))
        # edges by the offset of their end in the word, the longest first: an end occurs once for each length
        offset = (np.arange(len(padded)) - np.repeat(begin, sizes + 1))[stop]
        rank = (offset * self.longest + self.longest - (stop - start)).astype(np.int16)
        order = np.argsort(rank, kind="stable")
        rank, start, stop, score, piece = (x[order] for x in (rank, start, stop, score, piece))
        best = np.full(len(padded), NEVER)
        best[begin] = 0
        back, taken = np.zeros(len(padded), np.int64), np.zeros(len(padded), np.int64)
        cuts = [0, *(np.nonzero(np.diff(rank))[0] + 1).tolist(), len(rank)]
        for low, high in zip(cuts, cuts[1:]):
            starts, ends = start[low:high], stop[low:high]
            total = best[starts] + score[low:high]
            better = total > best[ends]
            ends = ends[better]
            best[ends], back[ends], taken[ends] = total[better], starts[better], piece[low:high][better]
        word, at = np.arange(len(words)), begin + sizes
        owners, pieces, froms = [], [], []
        while len(word):
            owners.append(word), pieces.append(taken[at]), froms.append(back[at])
            at = back[at]
            left = at > begin[word]
            word, at = word[left], at[left]
        owner, piece, start = map(np.concatenate, (owners, pieces, froms))
        order = np.argsort(start)
        ids, at = piece[order], (start - begin[owner])[order]
        raw = ids.astype(np.int32).tobytes()
        odd = np.zeros(len(words), bool)
        odd[owner[piece < 0]] = True
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        made = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.nonzero(odd)[0].tolist():
            w, a, b = words[i], ends[i - 1] // 4 if i else 0, ends[i] // 4
            each = (self.spelled(w[p]) if x < 0 else (x,) for x, p in zip(ids[a:b].tolist(), at[a:b].tolist()))
            made[i] = np.fromiter(chain.from_iterable(each), np.int32).tobytes()
        yield from zip(words, zip(made, best[begin + sizes].tolist()))

    def spelled(self, text: str) -> list[int]:
        """The ids of a text's bytes."""
        return [self.bytes[b] for b in text.encode("utf-8", "surrogatepass")]

    def cut(self, text: str) -> list[str]:
        """The segments of a whole text."""
        return self.segments.findall(f" {text}") if text else []

    def encode(self, text: str) -> np.ndarray:
        return self.join(self.cut(text))

    def join(self, segments: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join([self[s][0] for s in segments]), np.int32)

    def states(self, text: str, begin: int, cut: int | None, end: int) -> np.ndarray:
        """Scores to the positions from ``begin`` to ``end`` for each state at ``begin``, by row the position.

        With ``cut`` the only start is that position.
        """
        size = self.longest
        scores = {}
        if cut is None:
            for o in range(min(size, begin + 1)):
                scores[begin - o] = np.where(np.arange(size) == o, 0, NEVER)
        else:
            begin = cut
            scores[begin] = np.zeros(1, np.int64)
        width = len(scores[begin])
        for start in range(begin - (len(scores) - 1), end):
            if start not in scores:
                continue
            for stop, score, _ in self.edges(text, start, end):
                if stop > begin:
                    scores[stop] = np.maximum(scores.get(stop, NEVER), scores[start] + score)
        none = np.full(width, NEVER)
        return np.maximum(np.array([scores.get(p, none) for p in range(begin, end + 1)]), NEVER)

    def transfer(self, context: str, core: str) -> np.ndarray:
        """The (max, +) matrix of a chunk: the best score from each state at its start to each at its end."""
        size, text = self.longest, context + core
        begin, end = len(context), len(text)
        cuts = [m.start() for m in self.segments.finditer(text) if m.start() >= max(begin, 1)]
        matrix = np.full((size, size), NEVER)
        if not cuts:
            reached = self.states(text, begin, None, end)
            for o in range(min(size, end - begin + 1)):
                matrix[:, o] = reached[end - o - begin]
            if end - begin < size:  # no path may skip the chunk
                matrix[:, end - begin] = NEVER
            return matrix
        head = self.states(text, begin, None, cuts[0])[-1]
        middle = sum(self[text[a:b]][1] for a, b in zip(cuts, cuts[1:]))
        tail = self.states(text, begin, cuts[-1], end)[:, 0]
        for o in range(min(size, len(tail))):
            matrix[:, o] = np.where(head > NEVER, head + middle, NEVER) + tail[len(tail) - 1 - o]
        return np.maximum(matrix, NEVER)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


def boundary_states(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The states of one best path at all boundaries, from ``first`` to ``last``."""
    row = np.where(np.arange(len(matrices[0])) == first, 0, NEVER)
    rows = [row]
    for m in matrices:
        row = np.maximum((row[:, None] + m).max(axis=0), NEVER)
        rows.append(row)
    out = [last]
    for row, m in zip(rows[-2::-1], matrices[::-1]):
        out.append(int(np.argmax(row + m[:, out[-1]])))
    return out[::-1]


def _square(raw: bytes) -> np.ndarray:
    values = np.frombuffer(raw, np.int64)
    return values.reshape(math.isqrt(len(values)), -1)


def encoder(pieces: list[tuple[str, bool]]):
    """A column function: the ids of a text, in one task."""

    @F.arrow_udf("array<int>")
    @lean
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(pieces)
        for texts in batches:
            each, held, size = [], [], 0
            for t in chain(texts.to_pylist(), [None]):
                if t is not None:
                    held.append(lattice.cut(t))
                    size += len(t)
                if t is None or size >= HELD:
                    lattice.remember(set().union(*held))
                    each += [lattice.join(c) for c in held]
                    held, size = [], 0
            ends = np.cumsum([0, *map(len, each)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *each])))

    return encode


def decoder(pieces: list[tuple[str, bool]]):
    """A column function: the text of ids; ids of control pieces add nothing."""
    raw = [
        p.encode() if usable else bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else b""
        for p, usable in pieces
    ]

    @F.arrow_udf("string")
    @lean
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = np.array([len(r) for r in raw])
        places = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(raw), np.uint8)
        for lists in batches:
            out = []
            for ids in lists:
                if not ids.is_valid:
                    out.append(None)
                    continue
                ids = ids.values.to_numpy(zero_copy_only=False)
                n = sizes[ids]
                begin = np.cumsum(n) - n
                at = np.repeat(places[ids] - begin, n) + np.arange(n.sum())
                out.append(flat[at].tobytes().decode("utf-8", "replace")[1:])
            yield pa.array(out, pa.string())

    return decode


def encode(documents: DataFrame, out: str = "ids", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``documents`` with column ``out``: the ids of each whole text."""
    small_batches(documents.sparkSession)
    pieces = vocabulary(model)
    if chunk <= 2 * max(len(p) for p, _ in pieces):
        raise ValueError("a chunk must be longer than two pieces")
    long = F.length(text_of("text")) > chunk
    plain = documents.where(~long).withColumn(out, encoder(pieces)(text_of("text")))
    key = fresh(documents, "sha")
    giant = documents.where(long).withColumn(key, F.sha2("text", 256))
    solved = _scan(giant.select(F.col(key).alias("sha"), "text"), pieces, chunk).toDF(key, out)
    return plain.unionByName(giant.join(solved, key).drop(key))


def _scan(texts: DataFrame, pieces: list[tuple[str, bool]], chunk: int) -> DataFrame:
    """``sha`` and ids of each distinct text."""

    @lean
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        reach = lattice.longest - 1
        for batch in batches:
            for sha, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = f" {text}"
                for i, at in enumerate(range(0, len(text), chunk)):
                    context, core = text[max(at - reach, 0) : at], text[at : at + chunk]
                    row = [[sha], [i], [len(context)], [context + core], [lattice.transfer(context, core).tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["sha", "i", "begin", "text", "matrix"])

    once = texts.dropDuplicates(["sha"])
    chunks = stored(once.mapInArrow(split, "sha string, i long, begin long, text string, matrix binary"), "chunks")
    cells = chunks.select("sha", F.floor(F.col("i") / BLOCK).alias("block"), "i", "matrix")

    def multiply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for m in rows.sort_values("i")["matrix"]:
            total = _square(m) if total is None else times(total, _square(m))
        return pd.DataFrame({"sha": [key[0]], "block": [key[1]], "matrix": [total.tobytes()]})

    def per_text(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        states = boundary_states([_square(m) for m in rows["matrix"]], 0, 0)
        return pd.DataFrame({"sha": key[0], "block": rows["block"], "first": states[:-1], "last": states[1:]})

    def per_block(key: tuple, rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        states = boundary_states([_square(m) for m in rows["matrix"]], int(ends["first"].iloc[0]), int(ends["last"].iloc[0]))
        return pd.DataFrame({"sha": key[0], "i": rows["i"], "first": states[:-1], "last": states[1:]})

    blocks = cells.groupBy("sha", "block").applyInPandas(multiply, "sha string, block long, matrix binary")
    ends = blocks.groupBy("sha").applyInPandas(per_text, "sha string, block long, first int, last int")
    inner = (
        cells.groupBy("sha", "block")
        .cogroup(ends.groupBy("sha", "block"))
        .applyInPandas(per_block, "sha string, i long, first int, last int")
    )

    @lean
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            ids = []
            for begin, text, first, last in zip(*[batch.column(c).to_pylist() for c in ("begin", "text", "first", "last")]):
                ids.append(_trace(lattice, text, begin, first, last))
            yield pa.RecordBatch.from_arrays([batch.column("sha"), batch.column("i"), pa.array(ids, IDS)], ["sha", "i", "ids"])

    traced = chunks.drop("matrix").join(inner, ["sha", "i"]).mapInArrow(trace, "sha string, i long, ids array<int>")
    whole = traced.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("parts"))
    return whole.select("sha", F.flatten(F.col("parts.ids")).alias("ids"))


def _trace(lattice: Lattice, text: str, begin: int, first: int, last: int) -> list[int]:
    """The ids of a chunk's part of the path, from its cut before the chunk to its last one within."""
    path = text[begin - first : len(text) - last]
    cuts = [m.start() for m in lattice.segments.finditer(path)][1:]
    cuts = [c for c in cuts if c >= first] or [len(path)]
    out = [lattice.path(path[: cuts[0]], first)[0]] if first else []
    out += [lattice[m.group()][0] for m in lattice.segments.finditer(path, cuts[0] if first else 0)]
    return np.frombuffer(b"".join(out), np.int32).tolist()


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with column ``out``: the text that the ids stand for."""
    small_batches(rows.sparkSession)
    return rows.withColumn(out, decoder(vocabulary(model))(F.col(ids)))
