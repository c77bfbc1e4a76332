"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses. A lexical transducer rewrites each word as a symbol: insult, threat,
target, negation, reported speech or other. Scope transducers then mark insults and threats that
stand in the reach of a target, a negation or reported speech; they are composed one after the
other, those of the right context over the reversed clause. The weights of the marks multiply the
weight of the word, and a clause weighs what its insults and targeted threats weigh together.
``score = 1 - (1 - FLOOR) * exp(-sum of clause weights)``, so one plain insult is enough for 0.3
and a negated or quoted one is not.

The insults are learned: words, and word beginnings that several words share, which labelled
toxic documents hold and labelled clean ones do not. A short list of English insults holds
whatever the labels say. Everything but the lexicon is fixed.

Null and empty texts score ``FLOOR``. Repeated rows score alike. A label without a document, or
with a null id or value, teaches nothing; of conflicting labels of one document the toxic one holds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import lean, small_batches, stored, text_of

# The closed classes of the grammar and the insults that need no label.
INSULTS = "idiot idiots moron morons scum loser losers imbecile imbeciles vermin worthless pathetic disgusting stupid"
THREATS = "kill hurt destroy beat stab shoot burn hang attack punch"
TARGETS = "you your yours yourself u he she they them him her these those people all everyone"
NEGATIONS = "not no never isn't aren't wasn't weren't don't doesn't nobody neither nor hardly without"
REPORTS = "said says wrote called calls claimed claims quoted quote reported reports alleged according"

#: Rows of labelled documents the lexicon is fitted on, per class.
TOXIC_ROWS, CLEAN_ROWS = 3_000, 9_000
#: Least log-likelihood ratio and precision (classes weighted alike) of a learned entry.
EVIDENCE, PRECISION = 22.0, 0.95
PREFIXES = (4, 8)
#: How fast an entry's weight falls with the share of clean documents among those that hold it.
DOUBT = 60.0
MAX_ENTRIES = 5_000
FLOOR = 0.02
#: Weight factors and reach, in words, of the marks.
MARKS = {"-": ("N", 3, 0.2), "~": ("R", 6, 0.25), "+": ("G", 4, 1.25)}
INSULT_WEIGHT, THREAT_WEIGHT = 1.2, 0.9

CLAUSE = re.compile(r"[^.!?;\n]+")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


def scope(trigger: str, reach: int, mark: str) -> dict[tuple[int, str], tuple[int, str]]:
    """The transducer that adds ``mark`` to insults and threats at most ``reach`` words after a trigger.

    Its states count down the words that are left of the reach.
    """
    rules = {}
    for left in range(reach + 1):
        for symbol in "ITGNRO":
            if symbol == trigger:
                rules[left, symbol] = (reach, symbol)
            else:
                rules[left, symbol] = (max(left - 1, 0), symbol + mark * (left > 0 and symbol in "IT"))
    return rules


def transduce(rules: dict, symbols: list[str]) -> list[str]:
    """Run a scope transducer; marks of earlier ones stay on the symbols."""
    state, out = 0, []
    for symbol in symbols:
        state, made = rules[state, symbol[0]]
        out.append(made + symbol[1:])
    return out


class Grammar:
    """The composed transducers with a lexicon: exact words and beginnings, each with a weight."""

    def __init__(self, words: dict[str, float], prefixes: dict[str, float]):
        import ahocorasick

        self.words = {w: 1.0 for w in INSULTS.split()} | words
        self.prefixes = prefixes
        self.classes = {w: c for c, ws in zip("TGNR", (THREATS, TARGETS, NEGATIONS, REPORTS)) for w in ws.split()}
        self.lengths = sorted({len(p) for p in prefixes})
        self.left = [scope(t, n, m) for m, (t, n, _) in MARKS.items()]
        self.right = scope(*MARKS["+"][:2], "+")
        self.finder = ahocorasick.Automaton()
        for entry in {*self.words, *prefixes, *THREATS.split()}:
            self.finder.add_word(entry, entry)
        self.finder.make_automaton()

    def lexical(self, word: str) -> tuple[str, float]:
        if word in self.words:
            return "I", self.words[word] * INSULT_WEIGHT
        for n in self.lengths:
            if (weight := self.prefixes.get(word[:n])) is not None and len(word) >= n:
                return "I", weight * INSULT_WEIGHT
        symbol = self.classes.get(word, "O")
        return symbol, THREAT_WEIGHT * (symbol == "T")

    def clause(self, text: str) -> float:
        """The weight of one clause."""
        read = [self.lexical(w) for w in WORD.findall(text)]
        symbols = [s for s, _ in read]
        if "I" not in symbols and "T" not in symbols:
            return 0.0
        for rules in self.left:
            symbols = transduce(rules, symbols)
        symbols = transduce(self.right, symbols[::-1])[::-1]
        total = 0.0
        for symbol, (_, weight) in zip(symbols, read):
            if symbol[0] == "I" or (symbol[0] == "T" and "+" in symbol):
                for mark in set(symbol[1:]):
                    weight *= MARKS[mark][2]
                total += weight
        return total

    def score(self, text: str) -> float:
        text = text.lower()
        if next(self.finder.iter(text), None) is None:
            return FLOOR
        total = sum(self.clause(m.group()) for m in CLAUSE.finditer(text))
        return 1.0 - (1.0 - FLOOR) * math.exp(-total) if total else FLOOR


def word_counts(documents: DataFrame, labels: DataFrame, held_out: Column) -> tuple[DataFrame, int, int]:
    """Of the sampled labelled documents outside ``held_out``: in how many of each class a word stands.

    The sample holds the documents whose hashed id is smallest, at most ``TOXIC_ROWS`` and
    ``CLEAN_ROWS``. Copies and near copies, told by two minimum hashes of their word triples, count once,
    else every word of a much copied document would look like evidence.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
    chosen = chosen.unionAll(known.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("toxic", "text").where("text <> ''")
    rows = rows.withColumn("low", least_hashes()("text")).select("toxic", "text", "low.*")
    rows = rows.groupBy("toxic", "first").agg(F.min("text").alias("text"), F.min_by("second", "text").alias("second"))
    rows = rows.groupBy("toxic", "second").agg(F.min("text").alias("text")).select("toxic", "text")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update({w for w in WORD.findall(text.lower()) if len(w) > 2})
                seen[toxic][""] += 1  # the number of documents
        for toxic in (0, 1):
            words = list(seen[toxic])
            for at in range(0, len(words), 10_000):
                part = words[at : at + 10_000]
                n = [seen[toxic][w] for w in part]
                none = [0] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(n if toxic else none), pa.array(none if toxic else n)],
                    ["word", "toxic", "clean"],
                )

    counts = rows.mapInArrow(count, "word string, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return counts


def least_hashes():
    """A column function: the least values of two hashes over the word triples of a text."""

    @F.arrow_udf("struct<first:bigint,second:bigint>")
    @lean
    def low(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                words = WORD.findall(text.lower()) or [text]
                triples = [" ".join(words[i : i + 3]).encode() for i in range(max(len(words) - 2, 1))]
                out.append({"first": min(map(zlib.crc32, triples)), "second": min(zlib.crc32(t, 1) * 2654435761 % 2**32 for t in triples)})
            yield pa.array(out, pa.struct([("first", pa.int64()), ("second", pa.int64())]))

    return low


def learn(documents: DataFrame, labels: DataFrame, held_out: Column) -> tuple[dict[str, float], dict[str, float]]:
    """The learned words and word beginnings with their weights, at most ``MAX_ENTRIES`` of each."""
    counts = stored(word_counts(documents, labels, held_out), "words")
    total = counts.where("word = ''").first()
    if not total or not total.toxic or not total.clean:
        return {}, {}
    n1, n0 = float(total.toxic), float(total.clean)

    def evidence(rows: DataFrame) -> DataFrame:
        a, b = F.col("toxic"), F.col("clean")
        share = F.lit(n1 / (n1 + n0))
        gain = a * F.log(a / ((a + b) * share))
        gain += F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
        precision = (a / n1) / (a / n1 + b / n0)
        rows = rows.where("toxic > 0").withColumns({"gain": 2 * gain, "precision": precision})
        return rows.where((F.col("gain") >= EVIDENCE) & (F.col("precision") >= PRECISION))

    words = counts.where("word <> ''")
    low, high = PREFIXES
    cuts = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: n <= F.length("word"))
    begun = words.withColumn("n", F.explode(cuts)).withColumn("prefix", F.expr("substring(word, 1, n)"))
    begun = begun.groupBy("prefix").agg(
        F.sum("toxic").alias("toxic"),
        F.sum("clean").alias("clean"),
        F.max("toxic").alias("top"),
        F.count_if(F.col("toxic") > 0).alias("words"),
    )
    begun = begun.where("words >= 3 AND top <= 0.5 * toxic")
    best = lambda df, key: df.orderBy(F.desc("gain"), key).limit(MAX_ENTRIES).collect()
    prefixes = {r.prefix: math.exp((r.precision - 1) * DOUBT) for r in best(evidence(begun), "prefix")}
    short = {p: w for p, w in prefixes.items() if not any(p[:n] in prefixes for n in range(low, len(p)))}
    exact = {r.word: math.exp((r.precision - 1) * DOUBT) for r in best(evidence(words), "word")}
    return exact, short


def scorer(words: dict[str, float], prefixes: dict[str, float]):
    """A column function: the score of a text."""

    @F.arrow_udf("double")
    @lean
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grammar = Grammar(words, prefixes)
        for texts in batches:
            yield pa.array([grammar.score(t) for t in texts.to_pylist()], pa.float64())

    return score


def in_test_fold(column: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(documents: DataFrame, labels: DataFrame, out: str = "score", learn_from: DataFrame | None = None) -> DataFrame:
    """``documents`` with their score in column ``out``; texts of any length are read whole."""
    small_batches(documents.sparkSession)
    words, prefixes = learn(learn_from if learn_from is not None else documents, labels, in_test_fold())
    return documents.withColumn(out, scorer(words, prefixes)(text_of("text")))
