"""Divergence between the sources of a language, by count-level bitmaps.

Terms are runs of ASCII letters and other non-ASCII characters, with A-Z lower-cased. A language
keeps the terms that at least ``LEAST`` of its documents hold, V of them. A (language, source) group
gives a kept term that occurs ``c`` times the share ``p = 1 + floor(UNIT * (c + 1) / (N + V))``, N the
sum of its counts, and the language does likewise over all its sources. The divergence of p from q
is ``floor((p - q)^2 / q)``.

Shares depend on counts only, and a group has few different counts. So a group stores one bitmap
over the terms for each of its counts. Terms are numbered by falling frequency, which leaves few
different counts, and so few bitmaps, in a block of ``BITS`` terms. The terms in which two groups
have the counts c and d are the ones of an AND of two bitmaps; their number is multiplied by the
divergence of the two shares. The cells with a count of zero follow by complement from the sizes of
the bitmaps. A task works on a span of blocks and two tiles of ``TILE`` sources, so it holds a bounded
number of bitmaps.

Null text, language and source read as empty. Groups without terms take part with N = 0, and if V is 0
all their values are 0. Repeated rows count as often as they occur. Ties of rank go by the bytes of
the item. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import small_batches, stored, text_of
from lodestone.operators.topk import join_counted

LEAST = 3
UNIT = 1_000_000_000
TOP = 200
#: Terms of a bitmap (about; four words of 64 bits hold as many), blocks of a span, sources of a tile.
BITS, WORDS, SPAN, TILE = 192, 4, 32, 32
#: Rows of (group, term) that a task counts before it sends them on.
HELD = 800_000
#: Characters that are searched for terms at once.
SLICE = 1 << 20

#: Fixed value: the terms of the contract, over UTF-8 bytes, of which all of a non-ASCII character are above 0x7F.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
NO_TERM = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text; long texts are cut between terms. Lower case of bytes is that of A-Z only."""
    start = 0
    while start < len(text):
        cut = NO_TERM.search(text, start + SLICE) if len(text) - start > SLICE else None
        end = cut.start() if cut else len(text)
        yield TERM.findall(text[start:end].lower())
        start = end


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and documents ``df``; each group also has a row of the null term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in groups.items():
                terms = list(n)
                for i in range(0, len(terms), 50_000):
                    some = terms[i : i + 50_000]
                    names = pa.array(some, pa.binary()).cast(pa.string())
                    columns = [[lang] * len(some), [source] * len(some), names, [n[t] for t in some], [df[t] for t in some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, COUNTS.types)], schema=COUNTS)

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts.to_pylist()):
                if (lang, source) not in groups:
                    groups[lang, source] = Counter({None: 0}), Counter()
                    held += 1
                n, df = groups[lang, source]
                held -= len(n)
                met = set()
                for found in terms_of(text):
                    n.update(found)
                    met.update(found)
                df.update(met)
                held += len(n)
                if held > HELD:
                    yield from sent()
                    groups, held = {}, 0
        yield from sent()

    rows = documents.select(*[text_of(c).alias(c) for c in ("lang", "source", "text")])
    counts = rows.mapInArrow(count, "lang string, source string, term string, n long, df long")
    # dealt out by term, which serves both this sum and the sums over all sources
    return counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: str, total: str, kept: str) -> Column:
    """p of a count, in exact arithmetic; null if no term is kept."""
    return F.expr(
        f"1 + (CAST({UNIT} AS decimal(10,0)) * CAST({count} + 1 AS decimal(20,0)))"
        f" div CAST(nullif({kept}, 0) + {total} AS decimal(20,0))"
    )


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def kept_cells(documents: DataFrame, least: int) -> DataFrame:
    """``lang, source, term, n`` of the kept terms, their ``total`` over all sources, and whether the row leads its term.

    Each group also has a row of the null term.
    """
    term = W.partitionBy("lang", "term")
    columns = {"total": F.sum("n").over(term), "all_df": F.sum("df").over(term), "lead": F.min("source").over(term) == F.col("source")}
    rows = term_counts(documents).withColumns(columns)
    return rows.where((F.col("all_df") >= least) | F.col("term").isNull()).drop("df", "all_df")


def number_terms(cells: DataFrame) -> DataFrame:
    """Add the block, ``at`` and ``more``, and the ``bit`` of each row's term.

    Blocks follow falling totals. Terms of one total are spread by hash over the places they take up
    together, so no task ever orders all terms of a language; a block then has about ``BITS`` terms,
    and more than ``64 * WORDS`` continue in a block of their own.
    """
    sizes = cells.where("lead").groupBy("lang", "total").agg(F.count("*").alias("m"))
    before = W.partitionBy("lang").orderBy(F.desc("total")).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    rows = join_counted(cells, stored(sizes, "totals"), ["lang", "total"], "inner")
    place = F.col("before") + F.pmod(F.xxhash64("term"), F.col("m"))
    rows = rows.withColumn("at", F.floor(place / BITS)).drop("before", "m", "lead")
    inside = F.dense_rank().over(W.partitionBy("lang", "at").orderBy("term")) - 1
    rows = rows.withColumn("inside", inside)
    bit = F.pmod("inside", F.lit(64 * WORDS)).cast("int")
    return rows.withColumns({"more": F.floor(F.col("inside") / (64 * WORDS)), "bit": bit}).drop("inside")


def bitmaps(cells: DataFrame) -> DataFrame:
    """One bitmap, as the words ``w0`` on, per (lang, source, block, p), with the share ``zero`` of a count of zero."""
    bit = F.expr("shiftleft(1L, bit % 64)")
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("bit") / 64) == i, bit)), F.lit(0)).alias(f"w{i}") for i in range(WORDS)]
    return cells.groupBy("lang", "at", "more", "source", "p", "zero", "tile").agg(*words)


VALUES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def joint(rows: pa.Table) -> pa.Table:
    """Partial values of all pairs of sources of two tiles over a span of blocks.

    A joint cell counts for its divergence less what the complement assumes: that of the first
    count with a zero, of a zero with the second, plus that of two zeros.
    """
    numbers = {c: rows.column(c).to_numpy() for c in ("ta", "tb", "tile", "at", "more", "p", "zero")}
    ta, tb = numbers["ta"][0], numbers["tb"][0]
    names, source = np.unique(np.array(rows.column("source").to_pylist(), object), return_inverse=True)
    bits = np.stack([rows.column(f"w{i}").to_numpy() for i in range(WORDS)], axis=1).astype(np.int64).view(np.uint64)
    values = np.zeros((len(names), len(names)), np.int64)
    p, zero, tile = (numbers[c].astype(np.int64) for c in ("p", "zero", "tile"))
    blocks = numbers["at"].astype(np.int64) << 20 | numbers["more"].astype(np.int64)
    order = np.argsort(blocks, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(blocks[order])) + 1):
        first, second = part[tile[part] == ta], part[tile[part] == tb]
        for start in range(0, len(first), 128):
            some = first[start : start + 128]
            common = np.bitwise_count(bits[some, None, :] & bits[None, second, :]).sum(axis=2, dtype=np.int64)
            i, j = np.nonzero(common)
            n, i, j = common[i, j], some[i], second[j]
            for g, h in ((i, j), (j, i)) if ta != tb else ((i, j),):
                pg, qh, zg, zh = p[g], p[h], zero[g], zero[h]
                cell = (pg - qh) ** 2 // qh - (pg - zh) ** 2 // zh - (zg - qh) ** 2 // qh + (zg - zh) ** 2 // zh
                np.add.at(values, (source[g], source[h]), n * cell)
    g, h = np.nonzero(values)
    lang = [rows.column("lang")[0].as_py()] * len(g)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip((lang, names[g], names[h], values[g, h]), VALUES.types)], schema=VALUES)


def pair_values(maps: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` for every ordered pair of sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"), F.col("tile").alias("item_tile"))
    tiles = groups.select("lang", F.col("tile").alias("item_tile")).distinct()
    rows = join_counted(maps, tiles, "lang", "inner")
    rows = rows.withColumns({
        "ta": F.least("tile", "item_tile"), "tb": F.greatest("tile", "item_tile"),
        "span": F.floor(F.col("at") / SPAN),
    })
    rows = rows.drop("item_tile")
    cells = rows.groupBy("lang", "span", "ta", "tb").applyInArrow(joint, "lang string, source string, item string, value long")
    # the zeros of the other group, by complement: sizes of the bitmaps, all blocks together
    n = sum((F.bit_count(f"w{i}") for i in range(WORDS)), F.lit(0))
    levels = maps.groupBy("lang", "source", "p", "zero").agg(F.sum(n).alias("n"))
    levels = stored(levels, "levels")
    some = join_counted(levels, other, "lang", "inner").where("source <> item")
    both = divergence("zero", "item_zero")
    mine = some.select("lang", "source", "item", (F.col("n") * (divergence("p", "item_zero") - both)).alias("value"))
    theirs = some.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"),
        (F.col("n") * (divergence("item_zero", "p") - divergence("item_zero", "zero"))).alias("value"),
    )
    pairs = join_counted(groups, other, "lang", "inner").where("source <> item")
    empty = pairs.select("lang", "source", "item", F.coalesce(F.col("kept") * both, F.lit(0)).alias("value"))
    parts = cells.where("source <> item").unionByName(mine).unionByName(theirs).unionByName(empty)
    total = F.sum(F.col("value").cast("decimal(38,0)")).cast("long")
    return parts.groupBy("lang", "source", "item").agg(total.alias("value"))


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of both parts of the report.

    Part ``pair`` ranks the other sources of a language by the divergence of the group's shares from
    theirs, summed over the kept terms; part ``term`` the terms of a group whose share is above the
    language's, to rank ``top``.
    """
    small_batches(documents.sparkSession)
    rows = stored(kept_cells(documents, least), "kept")
    found = rows.where("term IS NOT NULL")
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    langs = found.where("lead").groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n"))
    groups = rows.where("term IS NULL").select("lang", "source")
    groups = join_counted(join_counted(groups, sums, ["lang", "source"], "left"), langs, "lang", "left")
    groups = groups.fillna(0, ["group_n", "kept", "lang_n"]).withColumn("none", F.lit(0))
    # tiles of sources by hash: as many as the language with most sources needs
    widest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    tile = F.pmod(F.xxhash64("source"), F.lit(-(-widest // TILE) or 1)).cast("int")
    groups = groups.withColumns({"zero": share("none", "group_n", "kept"), "tile": tile}).drop("none")
    groups = stored(groups, "groups")
    shares = {"p": share("n", "group_n", "kept"), "q": share("total", "lang_n", "kept")}
    cells = join_counted(number_terms(found), groups, ["lang", "source"], "inner").withColumns(shares)
    cells = stored(cells.drop("n", "total", "group_n", "kept", "lang_n"), "cells")
    above = cells.where("p > q").withColumn("value", divergence("p", "q"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    by_term = above.withColumnRenamed("term", "item").withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= top)
    maps = stored(bitmaps(cells), "bitmaps")
    by_pair = pair_values(maps, groups).withColumn("part", F.lit("pair")).withColumn("rank", rank)
    return by_pair.select(columns).unionByName(by_term.select(columns))
