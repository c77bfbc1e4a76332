"""Token counts of whole texts by a tokenizer compiled to a deterministic transducer.

A byte-level BPE tokenizer is compiled into one transducer over characters whose transitions carry
the net number of tokens that a character adds, so that the sum over a text is its token count at
every point (a transition may take tokens back: "the" is one token, "th" and "e" were two). A state
is a place in the pattern that cuts text into words (letters, digits, signs, blanks, contractions)
and the state of the word under way. The latter rests on a property of merging: the encoding of a
prefix ends in one certain token, the only token of the vocabulary that ends there and stands next
to the last token before it, where ``t1 t2`` may stand together if merging their joined bytes gives
back both. A word's state is thus its longest ending that begins a token, with the last token and
relative count at each place in it. States and transitions are compiled when first met and kept per
Python worker; beyond ``STATES`` they are forgotten and compiled anew.

Texts of more than ``CHUNK`` characters are cut and their chunks spread over the tasks. A chunk is
a map from entry states to exit states and counts; maps are composed per block of chunks, then per
text. Where a word certainly begins in the ``CONTEXT`` characters before a chunk its entry state is
known; else, within a giant word, its map holds the states that a beginning at any of these
characters leads to. If the composition meets an entry state that a map lacks, that chunk is run
again from this state, so results never depend on the guess.

Special tokens inside texts count as one token, as the library reads them; none are added. Null and
empty texts have no tokens. Repeated giant texts are counted once, every row gets its result. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import once_per_worker, small_batches, stored, text_of
from lodestone.operators.topk import join_counted

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Characters of a chunk; longer texts are scanned in parallel.
CHUNK = 65_536
#: Characters before a chunk that its entry states are taken from.
CONTEXT = 256
#: Chunks composed in one task.
BLOCK = 256
#: States a worker keeps, and the segments between sure word beginnings whose counts it keeps.
STATES = 250_000
REMEMBERED, REMEMBERED_LENGTH = 200_000, 64
#: A text up to the next blank that follows another character.
SEGMENT = re.compile(r"\s+(?:\S++(?:[^\S ]\s*+)?)*+|(?:\S++(?:[^\S ]\s*+)?)++")

START, LETTERS, DIGITS, SIGNS, BLANKS, QUOTE, QUOTE_LETTER = range(7)
#: Contractions of the word pattern, fixed values: 's 't 'm 'd 're 've 'll
SHORT = "stmd"
LONG = {"r": "e", "v": "e", "l": "l"}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others are numbered from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class State(dict):
    """State of the transducer; as a dict, the next state and added tokens by character.

    ``key`` is (mode, word, characters, word before the last blank, its count less the word's). A
    word is a tuple of the places where a token under way may have begun, earliest first: the node
    of the tree of tokens it has come to, the last token before it, and the count there less the
    word's count.
    """

    __slots__ = ("machine", "key")

    def __init__(self, machine: Machine, key: tuple):
        self.machine, self.key = machine, key

    def __missing__(self, char: str) -> tuple[State, int]:
        key, added = self.machine.after_character(self.key, char)
        made = self[char] = self.machine.state(key), added
        return made


class Machine:
    """The transducer of a byte-level BPE vocabulary in the file format of the tokenizers library."""

    EMPTY = ((0, -1, 0),)
    BEGIN = (START, EMPTY, "", None, 0)

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.cut = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        spec = json.loads(spec)
        code = byte_of_character()

        def raw(token: str) -> bytes:
            return bytes(code[c] for c in token)

        # tokens by number: the bytes, then one for each merge
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        number = {bytes([b]): b for b in range(256)}
        self.rank: dict[int, int] = {}
        self.halves: list[tuple[int, int] | None] = [None] * 256
        for left, right in merges:
            pair = number[raw(left)], number[raw(right)]
            self.rank[pair[0] << 32 | pair[1]] = len(self.halves)
            number.setdefault(raw(left + right), len(self.halves))
            self.halves.append(pair)
        # the tree of tokens: a step is node * 256 + byte
        self.steps: dict[int, int] = {}
        self.ends, self.inner = [-1], set()
        for token, i in number.items():
            node = 0
            for byte in token:
                self.inner.add(node)
                step = node << 8 | byte
                node = self.steps.setdefault(step, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.modes: dict[str, int] = {}
        self.together: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self.counts: dict[str, int] = {}

    def state(self, key: tuple) -> State:
        known = self.states.get(key)
        if known is None:
            if len(self.states) >= STATES:
                self.states = {}
            known = self.states[key] = State(self, key)
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives back both.

        The merges that made them are undone from the last one on. The two would not stay apart if
        what then meets at their border had merged before the merge just undone; of merges of the
        same rank the left one comes first.
        """
        undone, on_left = len(self.halves), False
        while True:
            joined = self.rank.get(left << 32 | right, len(self.halves))
            if joined < undone or joined == undone < len(self.halves) and not on_left:
                return False
            if left < 256 and right < 256:
                return True
            on_left = left > right
            if on_left:
                undone, left = left, self.halves[left][1]
            else:
                undone, right = right, self.halves[right][0]

    def after_byte(self, word: tuple, byte: int) -> tuple[tuple, int]:
        """The word after one more byte and the tokens that it adds."""
        places, token, added = [], -1, 0
        steps, ends, together = self.steps, self.ends, self.together
        for node, last, ahead in word:
            child = steps.get(node << 8 | byte)
            if child is None:
                continue
            found = ends[child]
            if found >= 0 and token < 0:
                if last < 0:
                    fits = True
                else:
                    fits = together.get(last << 32 | found)
                    if fits is None:
                        if len(together) >= 4 * STATES:
                            together.clear()
                        fits = together[last << 32 | found] = self.apart(last, found)
                if fits:
                    token, added = found, ahead + 1
            if child in self.inner:
                places.append((child, last, ahead))
        if added:
            places = [(node, last, ahead - added) for node, last, ahead in places]
        return (*places, (0, token, 0)), added

    def mode(self, char: str) -> int:
        """Kind of a character as the library's own word pattern sees it."""
        known = self.modes.get(char)
        if known is None:
            for known, probe in ((LETTERS, "a"), (DIGITS, "1"), (SIGNS, "!"), (BLANKS, "\n")):
                if len(self.cut(probe + char)) == 1:
                    break
            else:
                raise ValueError(f"unknown kind of character {char!r}")
            self.modes[char] = known
        return known

    def grow(self, word: tuple, chars: str) -> tuple[tuple, int]:
        """The word after further characters and the tokens that they add."""
        added = 0
        for byte in chars.encode():
            word, more = self.after_byte(word, byte)
            added += more
        return word, added

    def begin(self, char: str) -> tuple[tuple, int]:
        mode = self.mode(char)
        word, count = self.grow(self.EMPTY, char)
        if mode == BLANKS:
            return (BLANKS, word, char, self.EMPTY, -count), count
        return (QUOTE if char == "'" else mode, word, "", None, 0), count

    def size(self, chars: str) -> int:
        return self.grow(self.EMPTY, chars)[1]

    def after_character(self, key: tuple, char: str) -> tuple[tuple, int]:
        mode, word, chars, before, less = key
        if mode == QUOTE:
            if char in SHORT:
                return self.BEGIN, self.size("'" + char) - self.size("'")
            if char in LONG:
                letter, count = self.grow(self.EMPTY, char)
                return (QUOTE_LETTER, letter, char, None, 0), count
            mode = SIGNS
        elif mode == QUOTE_LETTER:
            if char == LONG[chars]:
                return self.BEGIN, self.size("'" + chars + char) - self.size("'") - self.size(chars)
            mode = LETTERS
        kind = self.mode(char)
        if mode == kind:
            grown, added = self.grow(word, char)
            if kind == BLANKS:
                return (BLANKS, grown, char, word, -added), added
            return (mode, grown, "", None, 0), added
        if mode != BLANKS:
            return self.begin(char)
        if chars == " ":  # the last blank goes with the word it precedes
            grown, added = self.grow(self.EMPTY, " " + char)
            return (kind, grown, "", None, 0), less + added
        key, added = self.begin(char)
        return key, less + self.size(chars) + added

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The state after ``text`` and the tokens that it adds."""
        count, place = 0, 0
        for found in self.special.finditer(text):
            for char in text[place : found.start()]:
                state, added = state[char]
                count += added
            state, count, place = self.start(), count + 1, found.end()
        for char in text[place:]:
            state, added = state[char]
            count += added
        return state, count

    def start(self) -> State:
        return self.state(self.BEGIN)

    def count(self, text: str) -> int:
        """The tokens of a text: at a blank after another character a word begins whatever came before."""
        if self.special.search(text):
            return self.run(self.start(), text)[1]
        total, counts = 0, self.counts
        for segment in SEGMENT.findall(text):
            known = counts.get(segment)
            if known is None:
                known = self.run(self.start(), segment)[1]
                if len(segment) <= REMEMBERED_LENGTH:
                    if len(counts) >= REMEMBERED:
                        counts.clear()
                    counts[segment] = known
            total += known
        return total

    def entries(self, context: str | None) -> list[State]:
        """The states in which the text before a chunk may leave the transducer; None: its start."""
        if context is None:
            return [self.start()]
        sure = [m.end() for m in self.special.finditer(context)]
        sure += [i for i in range(1, len(context)) if context[i] == " " and self.mode(context[i - 1]) != BLANKS]
        places = [max(sure)] if sure else range(len(context) + 1)
        found = {self.run(self.start(), context[i:])[0].key for i in places}
        return [self.state(key) for key in sorted(found, key=repr)]

    def chunks(self, text: str, size: int) -> Iterator[tuple[str | None, str]]:
        """The chunks of a text, each with the characters before it; none ends in a special token."""
        inside = ((m.start(), m.end()) for m in self.special.finditer(text))
        special, at = next(inside, None), 0
        while at < len(text):
            end = min(at + size, len(text))
            while special and special[1] <= end:
                special = next(inside, None)
            if special and special[0] < end:
                end = special[1]
            yield (text[max(0, at - CONTEXT) : at] if at else None), text[at:end]
            at = end


PIECES = "key string, i long, context string, chunk string"
MAPS = "key string, i long, entry string, exit string, n long"
#: A block's map: where it ends, or the chunk and entry state it stops at for want of a transition.
BLOCKS = "key string, block long, entry string, exit string, n long, i long"


def compose(steps: dict[int, dict[str, tuple[str, int]]], first: int, last: int, entry: str) -> tuple[str, int, int | None]:
    """Follow the maps ``steps`` from chunk ``first`` to ``last``: exit, count, and the chunk that lacks an entry."""
    count = 0
    for i in range(first, last + 1):
        found = steps[i].get(entry)
        if found is None:
            return entry, count, i
        entry, count = found[0], count + found[1]
    return entry, count, None


def as_table(rows: list[tuple], names: str, types: str) -> pa.Table:
    schema = pa.schema([(n, pa.string() if t == "s" else pa.int64()) for n, t in zip(names.split(), types)])
    return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)


def block_maps(rows: pa.Table) -> pa.Table:
    steps: dict[int, dict] = {}
    for r in rows.to_pylist():
        steps.setdefault(r["i"], {})[r["entry"]] = r["exit"], r["n"]
    first, last = min(steps), max(steps)
    key = rows.column("key")[0].as_py()
    out = [(key, first // BLOCK, e, *compose(steps, first, last, e)) for e in sorted(steps[first])]
    return as_table(out, "key block entry exit n i", "slssll")


def giant_counts(giant: DataFrame, machine, start: str, chunk: int) -> DataFrame:
    """``key`` and ``n_tokens`` of the distinct texts of ``giant`` (key, text)."""
    spark = giant.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, (context, part) in enumerate(machine().chunks(text, chunk)):
                    columns = [pa.array([v], t) for v, t in ((key, pa.string()), (i, pa.int64()), (context, pa.string()), (part, pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "i", "context", "chunk"])

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine()
        for batch in batches:
            for row in batch.to_pylist():
                if row.get("entry") is not None:
                    entries = [m.state(ast.literal_eval(row["entry"]))]
                else:
                    entries = m.entries(row["context"])
                out = []
                for state in entries:
                    key = repr(state.key)
                    end, n = m.run(state, row["chunk"])
                    out.append({"key": row["key"], "i": row["i"], "entry": key, "exit": repr(end.key), "n": n})
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("key", pa.string()), ("i", pa.int64()), ("entry", pa.string()), ("exit", pa.string()), ("n", pa.int64())])
    # one row per chunk of a text, dealt out by chunk
    pieces = stored(giant.mapInArrow(cut, PIECES).dropDuplicates(["key", "i"]), "chunks")
    known = stored(pieces.mapInArrow(maps, MAPS), "maps")

    def per_text(rows: pa.Table) -> pa.Table:
        """Total of a text, or the chunk and state that its composition stops at."""
        steps: dict[int, dict] = {}
        for r in rows.to_pylist():
            steps.setdefault(r["block"], {})[r["entry"]] = r["exit"], r["n"], r["i"]
        state, count, stop = start, 0, None
        for block in sorted(steps):
            if state not in steps[block]:
                stop = block * BLOCK
                break
            state, more, stop = steps[block][state]
            count += more
            if stop is not None:
                break
        return as_table([(rows.column("key")[0].as_py(), state, count, stop)], "key entry n i", "ssll")

    while True:
        blocks = known.withColumn("block", F.floor(F.col("i") / BLOCK)).groupBy("key", "block").applyInArrow(block_maps, BLOCKS)
        found = stored(blocks.groupBy("key").applyInArrow(per_text, "key string, entry string, n long, i long"), "texts")
        missing = found.where("i IS NOT NULL").select("key", "i", "entry")
        if missing.isEmpty():
            return found.select("key", F.col("n").alias("n_tokens"))
        again = join_counted(pieces, missing, ["key", "i"], "inner").mapInArrow(maps, MAPS)
        known = known.unionByName(stored(again, "maps"))


def token_counts(
    documents: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    column: str = "text",
    key: str = "doc_id",
    chunk: int = CHUNK,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    ``path`` is a byte-level BPE vocabulary in the tokenizers library's file format, read at the driver.
    """
    spark = documents.sparkSession
    small_batches(spark)
    with open(path or vocabulary_path(), encoding="utf-8") as file:
        spec = file.read()
    machine = once_per_worker(spark, spec, Machine)
    start = repr(Machine.BEGIN)

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([machine().count(t) for t in texts.to_pylist()], pa.int64())

    rows = documents.select(F.col(key), text_of(column).alias("text"))
    giant = rows.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    totals = giant_counts(giant.select("key", "text"), machine, start, chunk)
    short = rows.where(F.length("text") <= chunk)
    size = F.octet_length("text").cast("long").alias("n_bytes")
    short = short.select(key, size, counted("text").alias("n_tokens"))
    giant = join_counted(giant.select(key, size, "key"), totals, "key", "inner").select(key, "n_bytes", "n_tokens")
    return short.unionByName(giant).withColumn("over_limit", F.col("n_tokens") > limit)
