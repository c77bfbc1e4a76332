"""Secret scans over a trigram inverted index, in DataFrame operations only.

From the syntax tree of each rule's regex a Boolean query over trigrams is derived: alternatives
of sets of trigrams that every match holds. The index lists, for each trigram of any query, the
ids of the documents whose folded text holds it; a query intersects the postings by id, and only
the candidates are verified with the regex. A rule whose matches need not hold any trigram (hex
digits) is scanned for in every document.

Ids may repeat or be null: the postings of all rows of an id are merged, which can only add
candidates, and each row is verified on its own text. Null and empty texts hold no secret. Matches
are leftmost and do not overlap within a kind; offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fresh, stored, text_of
from lodestone.operators.topk import join_counted


@dataclass(frozen=True)
class Rule:
    """A regex and the fewest characters its match, or the group of its number, must have."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The kinds every scan must report, then further well-known forms of keys.
BASE = (
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED

#: Most strings a part of a regex is expanded to while its trigrams are derived.
EXPAND = 64


def _strings(node) -> set[str] | None:
    """All folded strings a part of a regex can match, or None if they are too many."""
    op, arg = node
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        out = set()
        for kind, value in arg:
            if kind is C.LITERAL:
                out.add(chr(value).lower())
            elif kind is C.RANGE and value[1] - value[0] < EXPAND:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is C.SUBPATTERN:
        return _joined(arg[-1])
    if op is C.BRANCH:
        each = [_joined(b) for b in arg[1]]
        return None if None in each else set().union(*each)
    if op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 2:
        one = _joined(arg[2])
        if one is None or len(one) ** arg[1] > EXPAND:
            return None
        return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)}
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > EXPAND:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of trigrams: every match holds all of one of them. Empty if none is mandatory.

    The runs of a sequence whose strings can be listed are tried; the most selective one is kept.
    """
    runs, run = [], {""}
    for node in [*P.parse(regex), None]:
        more = _strings(node) if node else None
        if more is None and node and node[0] is C.SUBPATTERN and len(node[1][-1]) > 1:
            inner = trigram_query_of(node[1][-1])
            runs += [inner] if inner else []
        if more is not None and len(run) * len(more) <= EXPAND:
            run = {a + b for a in run for b in more}
        else:
            runs.append([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run])
            run = more or {""}
    usable = [r for r in runs if r and all(r)]
    best = max(usable, key=lambda r: (min(map(len, r)), -len(r)), default=[])
    return sorted({s for s in best if not any(t < s for t in best)}, key=sorted)


def trigram_query_of(nodes) -> list[frozenset[str]]:
    strings = _joined(nodes)
    if strings is None:
        return []
    each = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return each if all(each) else []


def build_index(documents: DataFrame, grams: list[str], key: str, text: str) -> DataFrame:
    """Postings ``gram``, ``key``: which ids' folded texts hold each trigram."""
    folded = F.lower(text_of(text))
    rows = documents.select(F.col(key).alias("key"), folded.alias("t"))
    held = F.filter(F.array(*[F.when(F.contains("t", F.lit(g)), F.lit(g)) for g in grams]), F.isnotnull)
    return rows.select("key", F.explode(held).alias("gram")).select("gram", "key")


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Ids ``key`` with the ``rules`` whose query their postings satisfy."""
    number = {g: i for i, g in enumerate(sorted({g for q in queries.values() for s in q for g in s}))}
    if len(number) > 62:
        raise ValueError("split the rules: one intersection takes at most 62 trigrams")
    bit = F.create_map(*[x for g, i in number.items() for x in (F.lit(g), F.lit(1 << i))])
    lists = postings.groupBy("key").agg(F.bit_or(bit[F.col("gram")]).alias("bits"))
    hit = []
    for kind, query in queries.items():
        masks = [sum(1 << number[g] for g in grams) for grams in query]
        some = F.lit(False)
        for mask in masks:
            some = some | (F.col("bits").bitwiseAND(F.lit(mask)) == F.lit(mask))
        hit.append(F.when(some, F.lit(kind)))
    return lists.select("key", F.filter(F.array(*hit), F.isnotnull).alias("rules")).where(F.size("rules") > 0)


def running_sums(values: Column, block: int = 256) -> Column:
    """The running sums of an array of numbers; blocks bound the copying of long arrays."""

    def sums(xs: Column) -> Column:
        zero = F.array().cast("array<bigint>")
        grow = lambda acc, x: F.concat(acc, F.array(F.coalesce(F.element_at(acc, -1), F.lit(0)) + x))
        return F.aggregate(xs, zero, lambda acc, x: F.when(F.size(acc) == 0, F.array(x.cast("long"))).otherwise(grow(acc, x)))

    count = F.greatest(F.ceil(F.size(values) / block).cast("int"), F.lit(1))
    starts = F.transform(F.sequence(F.lit(0), count - 1), lambda b: b * block + 1)
    inner = F.transform(starts, lambda s: sums(F.slice(values, s, F.lit(block))))
    ends = sums(F.transform(inner, lambda xs: F.when(F.size(xs) > 0, F.element_at(xs, -1)).otherwise(F.lit(0).cast("long"))))
    before = F.concat(F.array(F.lit(0).cast("long")), ends)
    return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), count), lambda xs, b: F.transform(xs, lambda x: x + b)))


SPAN = "array<struct<start:bigint,place:int,kind:string,stop:bigint>>"


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """The spans of a rule in a text.

    The text is cut into pieces that each end with a match, or with the text; the running sums of
    their lengths are the ends of the matches.
    """
    pattern = F.lit(rf"(?s)(.*?)({rule.regex}|\z)")
    pieces = F.regexp_extract_all(text, pattern, F.lit(0))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), lambda m: F.length(m))
    part = F.transform(F.regexp_extract_all(text, pattern, F.lit(2 + rule.group)), lambda m: F.length(m)) if rule.group else whole
    ends = running_sums(F.transform(pieces, lambda p: F.length(p)))
    long_enough = F.zip_with(whole, part, lambda n, g: F.when((n > 0) & (g >= rule.least), n).otherwise(F.lit(0)))
    rows = F.zip_with(
        ends,
        long_enough,
        lambda e, n: F.struct(
            (e - n).alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), e.alias("stop")
        ),
    )
    return F.filter(rows, lambda r: r["start"] < r["stop"]).cast(SPAN)


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", out: str = "spans") -> DataFrame:
    """``documents`` with column ``out``: spans by start, then by the order of the rules."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex))}
    named = fresh(documents, "rules")
    rows = documents.withColumn(named, F.array().cast("array<string>"))
    if queries:
        grams = sorted({g for q in queries.values() for s in q for g in s})
        found = stored(candidates(build_index(documents, grams, key, text), queries), "candidates")
        found = found.where("key IS NOT NULL").toDF(fresh(documents, "candidate"), named)
        # rows without an id have no postings of their own: they are verified for every rule
        wide = documents.withColumn(found.columns[0], F.col(key))
        rows = join_counted(wide, found, found.columns[0], "left").drop(found.columns[0])
        every = F.array(*[F.lit(k) for k in queries])
        rows = rows.withColumn(named, F.when(F.col(key).isNull(), every).otherwise(F.col(named)))
    each = []
    none = F.array().cast(SPAN)
    for place, rule in enumerate(rules):
        due = F.rlike(text_of(text), F.lit(rule.regex))
        if rule.kind in queries:
            due = F.array_contains(F.col(named), rule.kind) & due
        each.append(F.when(due, spans_of(text_of(text), rule, place)).otherwise(none))
    spans = F.array_sort(F.concat(*each))
    spans = F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    order = documents.columns
    return rows.withColumn(out, spans).select(*order, out)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``documents`` with every secret replaced by ``mask``; ``n_chars``, if present, is counted anew.

    Overlapping spans are replaced as one.
    """
    out = fresh(documents, "spans")
    rows = scan(documents, out=out)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("made"))

    def step(acc: Column, s: Column) -> Column:
        fresh_part = F.substr(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        made = F.when(s["start"] >= acc["at"], F.concat(acc["made"], fresh_part, F.lit(mask))).otherwise(acc["made"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), made.alias("made"))

    tail = lambda acc: F.concat(acc["made"], F.substr(F.col("text"), (acc["at"] + 1).cast("int")))
    text = F.when(F.size(out) > 0, F.aggregate(out, start, step, tail)).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in documents.columns:
        size = F.when(F.size(out) > 0, F.length("text").cast(documents.schema["n_chars"].dataType))
        rows = rows.withColumn("n_chars", size.otherwise(F.col("n_chars")))
    return rows.select(documents.columns)
