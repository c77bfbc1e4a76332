"""BM25 over blocks of documents.

A block holds the postings of a few thousand documents by term, with each term's largest frequency
and shortest document there, which bound what the term can add to any score of the block. A search
sends the query terms to the blocks: scores are added inside the task that holds the block, a block
is skipped for the queries whose bound lies below their k-th score so far, and only k hits per
query leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.text import term_counts, tokens
from lodestone.operators.dense import Scan, flat_id, nested_id
from lodestone.operators.topk import deepest, join_counted, limit_per_query, rank_hits
from lodestone.session import cut_lineage
from lodestone.workers import lean, small_batches

K1 = 1.2
B = 0.75
TERM_ROWS = 500_000  # largest (query, term) table sent to every task
HOT_ROWS = 1_000_000  # postings of one term that one task may hold in a shuffled join
BLOCK_DOCS, BLOCK_POSTINGS = 4_096, 250_000  # a block ends with the document that reaches either
SCORE_CELLS = 500_000  # scores of a block held at once


@dataclass
class SparseIndex:
    """``postings`` (term, id, dl, tf) and ``lengths`` (id, dl); ``terms`` and ``blocks`` once it is stored.

    ``by_document`` are the postings of an index not stored, in the order of the documents, with
    their running number ``doc``.
    """

    postings: DataFrame
    lengths: DataFrame
    terms: DataFrame | None = None
    blocks: DataFrame | None = None
    by_document: DataFrame | None = None

    def term_stats(self) -> DataFrame:
        """``term, df, cf``: documents holding the term, and its occurrences."""
        if self.terms is not None:
            return self.terms
        return self.postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))

    def packed(self, wanted: DataFrame | None = None) -> DataFrame:
        """The blocks; of an index not stored, made of the postings of the ``wanted`` terms."""
        if self.blocks is not None:
            return self.blocks
        rows = self.by_document
        if rows is None:  # postings in any order are gathered by document
            whole = self.postings.groupBy("id").agg(F.first("dl").alias("dl"), F.collect_list(F.struct("term", "tf")).alias("c"))
            whole = whole.withColumn("doc", F.monotonically_increasing_id())
            rows = whole.select("doc", "id", "dl", F.inline("c")).select("doc", "term", "id", "dl", "tf")
        if wanted is not None:
            rows = rows.join(F.broadcast(wanted), "term", "left_semi")
        return pack(rows)

    def write(self, path: str) -> "SparseIndex":
        """Store the index as blocks of documents."""
        spark = self.postings.sparkSession
        self.packed().write.mode("overwrite").parquet(f"{path}/blocks")
        self.lengths.write.mode("overwrite").parquet(f"{path}/lengths")
        stats = term_sizes(spark.read.parquet(f"{path}/blocks"))
        stats.write.mode("overwrite").parquet(f"{path}/terms")
        return SparseIndex.read(spark, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "SparseIndex":
        blocks, lengths, terms = [spark.read.parquet(f"{path}/{t}") for t in ("blocks", "lengths", "terms")]
        return SparseIndex(unpack(blocks), lengths, terms, blocks)


def build_sparse_index(docs: DataFrame, text: str = "text") -> SparseIndex:
    """Index ``id, <text>``; documents without tokens count towards the corpus size."""
    split = docs.select("id", tokens(F.col(text)).alias("__t"))
    split = split.withColumn("dl", F.size("__t").cast("bigint"))
    # The outer form keeps Spark from tokenising a second time to filter empty lists.
    numbered = split.withColumn("doc", F.monotonically_increasing_id())
    counted = numbered.select("doc", "id", "dl", F.explode_outer(term_counts(F.col("__t"))).alias("__c"))
    rows = counted.where(F.col("__c").isNotNull()).select("doc", "__c.term", "id", "dl", "__c.tf")
    return SparseIndex(rows.select("term", "id", "dl", "tf"), split.select("id", "dl"), by_document=rows)


#: Lists of a block by document (``ids``, ``dls``), by term (``terms``, ``starts`` in the postings,
#: ``most_tf``, ``least_dl``), and by posting (``places`` of the documents, ``tfs``).
def block_schema(id_type: T.DataType) -> T.StructType:
    kinds = {
        "ids": id_type, "dls": T.LongType(), "terms": T.StringType(), "starts": T.IntegerType(), "most_tf": T.LongType(),
        "least_dl": T.LongType(), "places": T.IntegerType(), "tfs": T.LongType(),
    }
    return T.StructType([T.StructField(n, T.ArrayType(t)) for n, t in kinds.items()])


def pack(rows: DataFrame) -> DataFrame:
    """Blocks of ``doc, term, id, dl, tf``, in which the rows of a ``doc`` follow each other."""
    small_batches(rows.sparkSession)
    schema = block_schema(rows.schema["id"].dataType)
    from pyspark.sql.pandas.types import to_arrow_schema

    names = to_arrow_schema(schema)

    def block(held: pa.Table) -> pa.RecordBatch:
        held = held.combine_chunks()
        doc, dl, tf = (held[c].to_numpy() for c in ("doc", "dl", "tf"))
        new = np.concatenate([[True], doc[1:] != doc[:-1]])
        place = np.cumsum(new) - 1
        coded = held["term"].combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0]))
        first = pa.array(np.flatnonzero(new))
        columns = {
            "ids": held["id"].take(first), "dls": dl[new], "terms": coded.dictionary.take(pa.array(code[order][starts])),
            "starts": starts, "most_tf": np.maximum.reduceat(tf[order], starts), "least_dl": np.minimum.reduceat(dl[order], starts),
            "places": place[order], "tfs": tf[order],
        }
        lists = []
        for field in names:
            values = columns[field.name]
            values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else pa.array(values)
            lists.append(pa.ListArray.from_arrays([0, len(values)], values.cast(field.type.value_type)).cast(field.type))
        return pa.RecordBatch.from_arrays(lists, schema=names)

    @lean
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size, last = [], 0, 0, None
        for batch in batches:
            doc = batch.column(0).to_numpy()
            if not len(doc):
                continue
            edges = np.flatnonzero(np.diff(doc)) + 1
            edges = [*([0] if last is not None and doc[0] != last else []), *edges]
            start = 0
            for edge in edges:  # a block ends between two documents only
                docs += 1
                if docs >= BLOCK_DOCS or size + edge - start >= BLOCK_POSTINGS:
                    held.append(batch.slice(start, edge - start))
                    yield block(pa.Table.from_batches(held))
                    held, docs, size, start = [], 0, 0, edge
            held.append(batch.slice(start))
            size += len(doc) - start
            last = doc[-1]
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return rows.select("doc", "term", "id", "dl", "tf").mapInArrow(blocks, schema)


def sizes_of(blocks: DataFrame) -> DataFrame:
    """``term``, the places ``start`` and ``stop`` of its postings in a block, and the block's lists."""
    stops = F.concat(F.slice("starts", 2, 1 << 30), F.array(F.size("places")))
    lists = F.arrays_zip("terms", "starts", stops.alias("stops"))
    rows = blocks.select(F.explode(lists).alias("t"), "ids", "dls", "places", "tfs")
    return rows.select(F.col("t.terms").alias("term"), F.col("t.starts").alias("start"), F.col("t.stops").alias("stop"), "ids", "dls", "places", "tfs")


def term_sizes(blocks: DataFrame) -> DataFrame:
    """``term, df, cf`` of all blocks."""
    rows = sizes_of(blocks)
    some = F.aggregate(F.slice("tfs", F.col("start") + 1, F.col("stop") - F.col("start")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    rows = rows.select("term", (F.col("stop") - F.col("start")).cast("bigint").alias("df"), some.alias("cf"))
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def unpack(blocks: DataFrame) -> DataFrame:
    """The postings ``term, id, dl, tf`` of all blocks."""
    rows = sizes_of(blocks)
    size = F.col("stop") - F.col("start")
    some = F.arrays_zip(F.slice("places", F.col("start") + 1, size).alias("p"), F.slice("tfs", F.col("start") + 1, size).alias("tf"))
    rows = rows.select("term", "ids", "dls", F.explode(some).alias("x"))
    return rows.select("term", F.get("ids", "x.p").alias("id"), F.get("dls", "x.p").alias("dl"), "x.tf")


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct ``query_id, term`` of ``sparse_query``, or of ``query_text`` where it is absent."""
    names = [c for c in ("sparse_query", "query_text") if c in queries.columns]
    text = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names])
    terms = queries.select("query_id", F.explode_outer(F.array_distinct(tokens(text))).alias("term"))
    return terms.where(F.col("term").isNotNull())


def saturation(tf, dl, avg_dl):
    """What a term adds to a score per unit of its idf; columns or arrays."""
    return tf * (K1 + 1) / (tf + K1 * ((1 - B) + B * dl / avg_dl))


class Asked:
    """Query terms with their weights, and the blocks that they are looked up in.

    Made once and used for the ranking and for the scores of given documents.
    """

    def __init__(self, queries: DataFrame, index: SparseIndex, term_rows: int = TERM_ROWS):
        self.queries, self.index = queries, index
        self.terms = query_terms(queries)
        self.held = self.terms.limit(term_rows + 1).toArrow()
        self.bounded = self.held.num_rows <= term_rows
        total = index.lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avg_dl")).first()
        self.n, self.avg_dl = total["n"], total["avg_dl"] or 1.0
        wanted = self.terms.select("term").distinct()
        if self.bounded and index.blocks is None:  # an index not stored is built once, for these terms
            self.blocks = cut_lineage(index.packed(wanted))
            stats = term_sizes(self.blocks)
        else:
            self.blocks, stats = index.blocks, index.term_stats()
        self.stats = join_counted(stats, wanted, "term", "left_semi", term_rows).select("term", "df")

    def weights(self) -> DataFrame:
        """``query_id, term, df, idf``."""
        idf = F.log((self.n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
        return self.terms.join(self.stats, "term").select("query_id", "term", "df", idf.alias("idf"))

    def best(self, k: int) -> DataFrame:
        """The ``k`` best documents per query of every task, or all scores if the terms do not fit: ``query_id, id, score``."""
        return self._scan(k) if self.bounded else self._shuffled()

    def _scan(self, k: int) -> DataFrame:
        blocks, avg_dl = self.blocks, self.avg_dl
        df = {r["term"]: r["df"] for r in self.stats.toArrow().to_pylist()}  # a row per query term at most
        found = self.held.filter(pa.array([t in df for t in self.held["term"].to_pylist()], pa.bool_()))
        ids = found["query_id"].combine_chunks().dictionary_encode()
        asking: dict[str, list[int]] = {}
        for term, query in zip(found["term"].to_pylist(), ids.indices.to_pylist()):
            asking.setdefault(term, []).append(query)
        idf = {t: float(np.log((self.n - df[t] + 0.5) / (df[t] + 0.5) + 1.0)) for t in asking}
        asking = {t: np.array(q) for t, q in asking.items()}
        query_ids = ids.dictionary
        one = blocks.select(F.element_at("ids", 1).alias("id"))
        _, fields, id_cols = flat_id(one)

        @lean
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = BlockScan(len(query_ids), k, id_cols, asking, idf, avg_dl)
            for batch in batches:
                for i in range(batch.num_rows):
                    state.add_block({n: batch.column(n)[i].values for n in batch.schema.names})
            out = state.result(query_ids)
            if out is not None:
                yield from out.combine_chunks().to_batches()

        kind = self.queries.schema["query_id"].dataType
        schema = T.StructType([T.StructField("query_id", kind), T.StructField("score", T.DoubleType()), *fields])
        return nested_id(blocks.mapInArrow(scan, schema), one)

    def _shuffled(self) -> DataFrame:
        """Terms and postings meet by term, frequent terms cut by document; partial scores are summed per pair."""
        weights = self.weights()
        parts = F.ceil(F.col("df") / F.lit(HOT_ROWS)).cast("int")
        spread = weights.withColumn("__s", F.explode(F.sequence(F.lit(0), parts - 1)))
        sized = self.index.postings.join(self.stats.select("term", parts.alias("__parts")), "term")
        salted = sized.withColumn("__s", F.pmod(F.xxhash64("id"), F.col("__parts")).cast("int"))
        return self._sums(salted.join(spread, ["term", "__s"]))

    def _sums(self, matched: DataFrame) -> DataFrame:
        part = F.col("idf") * saturation(F.col("tf"), F.col("dl"), self.avg_dl)
        rows = matched.withColumn("__p", part).groupBy("query_id", "id")
        return rows.agg(F.round(F.sum("__p"), 6).alias("score"))

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        """``query_id, id, score`` of the given (query_id, id) that share a term."""
        postings = unpack(self.blocks) if self.blocks is not None else self.index.postings
        ids = pairs.select("id").distinct()
        some = join_counted(postings, ids, "id", "left_semi").join(pairs, "id")
        return self._sums(some.join(self.weights(), ["query_id", "term"]))


class BlockScan(Scan):
    """Running top-k of every query over blocks of postings."""

    def __init__(self, queries: int, k: int, id_cols: list[str], asking: dict, idf: dict, avg_dl: float):
        super().__init__("dot", np.zeros((queries, 1)), k, id_cols)
        self.asking, self.idf, self.avg_dl = asking, idf, avg_dl

    def add_block(self, lists: dict[str, pa.Array]) -> None:
        terms = [(i, t) for i, t in enumerate(lists["terms"].to_pylist()) if t in self.asking]
        if not terms:
            return
        dls, tfs, places, starts, most, least = (
            lists[n].to_numpy(zero_copy_only=False) for n in ("dls", "tfs", "places", "starts", "most_tf", "least_dl")
        )
        stops = np.append(starts[1:], len(places))
        bound = np.zeros(len(self.queries))
        top = saturation(most, least, self.avg_dl)
        for i, term in terms:
            bound[self.asking[term]] += self.idf[term] * top[i]
        live = np.flatnonzero((bound > 0) & (bound + 1e-5 >= self.floor))  # scores are rounded
        step = max(1, SCORE_CELLS // len(dls))
        impact = saturation(tfs, dls[places], self.avg_dl)
        for start in range(0, len(live), step):
            some = live[start : start + step]
            row = np.full(len(self.queries), -1)
            row[some] = np.arange(len(some))
            scores = np.zeros((len(some), len(dls)))
            for i, term in terms:
                mine = row[self.asking[term]]
                mine = mine[mine >= 0]
                if len(mine):
                    span = slice(starts[i], stops[i])
                    scores[mine[:, None], places[span][None, :]] += self.idf[term] * impact[span]
            self._keep(lists["ids"], some, scores)

    def _keep(self, ids: pa.Array, some: np.ndarray, scores: np.ndarray) -> None:
        met = scores > 0
        scores = np.where(met, np.floor(scores * 1e6 + 0.5) / 1e6, -np.inf)
        if scores.shape[1] > self.k:
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k]
            self.floor[some] = np.maximum(self.floor[some], kth)
        q, place = np.nonzero(met & (scores >= self.floor[some][:, None]))
        flat = ids.take(pa.array(place))
        columns = flat.flatten() if pa.types.is_struct(flat.type) else [flat]
        found = pa.table({"qpos": some[q].astype(np.int64), "score": scores[q, place]} | dict(zip(self.id_cols, columns)))
        self.pending.append(found)
        self.waiting += found.num_rows
        if self.waiting > max(65_536, self.k * len(self.queries)):
            self._merge()


def sparse_search(queries: DataFrame, index: SparseIndex, k: int = 10, term_rows: int = TERM_ROWS) -> DataFrame:
    """BM25 top-k: ``query_id, rank, id, score``.

    A bounded table of query terms goes to the blocks of documents, which stay where they are. A
    larger one is shuffled by term, with frequent terms cut by document.
    """
    hits = Asked(queries, index, term_rows).best(deepest(queries, k))
    ranked = rank_hits(hits, deepest(queries, k)).select("query_id", "rank", "id", "score")
    return limit_per_query(ranked, queries, k)
