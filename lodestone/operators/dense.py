"""Exact nearest neighbours for a batch of queries.

Queries are a table ``query_id, query_vector [, top_k]``, the corpus a table ``id, values``.
A query table that fits a checked budget is sent to the tasks, which scan the corpus once in
Arrow batches as matrix products and keep k rows per query. A larger one is laid out with the
corpus on a grid of bounded blocks; every block emits k rows per query, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.vectors import METRICS, score_block, to_matrix
from lodestone.operators.topk import deepest, limit_per_query, rank_hits
from lodestone.workers import lean

DEFAULT_TOP_K = 10
QUERY_ROWS = 4_096  # most queries sent to every task
QUERY_BYTES = 64 << 20  # largest query matrix sent to every task
BLOCK_BYTES = 32 << 20  # matrix of the corpus rows of one grid block
BLOCK_QUERIES = 4_096  # queries of one grid block, while their matrix fits BLOCK_BYTES
BLOCK_CELLS = 2_000_000  # numbers held at once in a score or row matrix
MERGE_ROWS = 65_536  # candidates gathered before the running top-k is sorted again


def block_shape(dim: int, rows: int | None = None, queries: int | None = None) -> tuple[int, int]:
    """Rows and queries of one grid block."""
    fits = max(1, BLOCK_BYTES // (8 * dim))
    return rows or fits, queries or min(BLOCK_QUERIES, fits)


def flat_id(df: DataFrame, col: str = "id") -> tuple[list, list[T.StructField], list[str]]:
    """An id as plain sortable columns: expressions, their schema fields and their names."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StructType):
        names = [f"{col}__{f.name}" for f in kind.fields]
        exprs = [F.col(col)[f.name].alias(n) for f, n in zip(kind.fields, names)]
        return exprs, [T.StructField(n, f.dataType) for f, n in zip(kind.fields, names)], names
    return [F.col(col)], [T.StructField(col, kind)], [col]


def nested_id(df: DataFrame, like: DataFrame, col: str = "id") -> DataFrame:
    """Undo ``flat_id``."""
    kind = like.schema[col].dataType
    if not isinstance(kind, T.StructType):
        return df
    names = [f"{col}__{f.name}" for f in kind.fields]
    packed = F.struct(*[F.col(n).alias(f.name) for f, n in zip(kind.fields, names)])
    return df.withColumn(col, packed).drop(*names)


def best_rows(hits: pa.Table, id_cols: list[str], k: int) -> pa.Table:
    """The ``k`` best rows of every query in a bounded table."""
    if hits.num_rows == 0:
        return hits
    keys = [("qpos", "ascending"), ("score", "descending")] + [(c, "ascending") for c in id_cols]
    hits = hits.take(pc.sort_indices(hits, sort_keys=keys, null_placement="at_start"))
    q = hits["qpos"].to_numpy()
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return hits.filter(pa.array(place < k))


def of_dim(batch: pa.RecordBatch | pa.Table, dim: int) -> pa.RecordBatch | pa.Table:
    """The rows whose vector has ``dim`` elements."""
    fits = pc.equal(pc.list_value_length(batch.column("values")), dim)
    return batch if pc.all(fits.fill_null(False), min_count=0).as_py() else batch.filter(fits)


class Scan:
    """Running top-k of every query over a stream of corpus batches.

    Candidates below a query's known k-th score are dropped at once; the others are gathered
    and sorted into the running result in bulk.
    """

    def __init__(self, metric: str, queries: np.ndarray, k: int, id_cols: list[str]):
        self.metric, self.queries, self.k, self.id_cols = metric, queries, k, id_cols
        self.floor = np.full(len(queries), -np.inf)
        self.best: pa.Table | None = None
        self.pending: list[pa.Table] = []
        self.waiting = 0

    def add(self, batch: pa.RecordBatch | pa.Table, which: np.ndarray | None = None) -> None:
        """Score a batch against all queries, or those at the places ``which``."""
        which = np.arange(len(self.queries)) if which is None else which
        step = max(1, BLOCK_CELLS // max(len(which), self.queries.shape[1]))
        for start in range(0, batch.num_rows, step):
            self._add(batch.slice(start, step), which)

    def _add(self, batch: pa.RecordBatch | pa.Table, which: np.ndarray) -> None:
        matrix = to_matrix(batch.column("values"), self.queries.shape[1])
        if "scale" in batch.schema.names:
            matrix = matrix * batch.column("scale").to_numpy()[:, None]
        finite = np.isfinite(matrix).all(axis=1)
        if not finite.all():
            matrix, batch = matrix[finite], batch.filter(pa.array(finite))
        scores, floor = score_block(self.metric, matrix, self.queries[which]), self.floor[which]
        # A first bound from the first block; later ones come from the merged result. Ties with
        # the k-th score stay in until ids break them.
        if len(scores) > self.k and not np.isfinite(floor).all():
            floor = self.floor[which] = np.maximum(floor, np.partition(scores, -self.k, axis=0)[-self.k])
        row, q = np.nonzero(scores >= floor)
        found = pa.table(
            {"qpos": which[q].astype(np.int64), "score": scores[row, q]}
            | {c: batch.column(c).take(pa.array(row)) for c in self.id_cols}
        )
        self.pending.append(found)
        self.waiting += found.num_rows
        if self.waiting > max(MERGE_ROWS, self.k * len(self.queries)):
            self._merge()

    def _merge(self) -> None:
        if not self.pending:
            return
        parts = self.pending if self.best is None else [self.best, *self.pending]
        self.best = best_rows(pa.concat_tables(parts), self.id_cols, self.k)
        self.pending, self.waiting = [], 0
        counts = np.bincount(self.best["qpos"].to_numpy(), minlength=len(self.queries))
        full = counts >= self.k
        worst = self.best["score"].to_numpy()[np.cumsum(counts)[full] - 1]
        self.floor[full] = np.maximum(self.floor[full], worst)

    def result(self, query_ids: pa.Array) -> pa.Table | None:
        self._merge()
        if self.best is None:
            return None
        ids = query_ids.take(self.best["qpos"])
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        return self.best.set_column(0, "query_id", ids)


def _broadcast_scan(
    queries: pa.Table, corpus: DataFrame, query_id_type: T.DataType, k: int, metric: str
) -> DataFrame:
    exprs, fields, id_cols = flat_id(corpus)
    dim = len(queries["query_vector"][0])
    matrix = to_matrix(queries["query_vector"], dim)
    query_ids = queries["query_id"].combine_chunks()
    extra = ["scale"] if "scale" in corpus.columns else []

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Scan(metric, matrix, k, id_cols)
        for batch in batches:
            state.add(of_dim(batch, dim))
        out = state.result(query_ids)
        if out is not None:
            yield from out.combine_chunks().to_batches()

    schema = T.StructType(
        [T.StructField("query_id", query_id_type), T.StructField("score", T.DoubleType()), *fields]
    )
    rows = corpus.select(*exprs, "values", *extra)
    return nested_id(rows.mapInArrow(scan, schema), corpus)


def _salts(rows: int, block: int) -> int:
    return max(1, -(-rows // block))


def grid_scan(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str,
    dim: int,
    key: str | None = None,
    salts: DataFrame | None = None,
    block_rows: int | None = None,
    block_queries: int | None = None,
) -> DataFrame:
    """Top-k per query and block, over blocks of bounded size.

    Without ``key`` every query meets every row. With it they meet where the key agrees, and
    ``salts`` (key, row_salts, query_salts) says into how many parts each side of a key is cut.
    """
    exprs, fields, id_cols = flat_id(corpus)
    extra = ["scale"] if "scale" in corpus.columns else []
    if key is None:
        block_rows, block_queries = block_shape(dim, block_rows, block_queries)
        row_salts = F.lit(_salts(corpus.count(), block_rows))
        query_salts = F.lit(_salts(queries.count(), block_queries))
        left = queries.withColumns({"__key": F.lit(0), "__rs": row_salts, "__qs": query_salts})
        right = corpus.withColumns({"__key": F.lit(0), "__rs": row_salts, "__qs": query_salts})
    else:
        sizes = salts.select(
            F.col(key), F.col("row_salts").alias("__rs"), F.col("query_salts").alias("__qs")
        )
        left = queries.join(sizes, key).withColumn("__key", F.col(key))
        right = corpus.join(sizes, key).withColumn("__key", F.col(key))
    query_cell = F.pmod(F.xxhash64("query_id"), F.col("__qs").cast("bigint"))
    row_cell = F.pmod(F.xxhash64("id"), F.col("__rs").cast("bigint"))
    left = left.withColumn("__q", query_cell).withColumn(
        "__r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__rs").cast("bigint") - 1))
    )
    right = right.withColumn("__r", row_cell).withColumn(
        "__q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__qs").cast("bigint") - 1))
    )
    cell = ["__key", "__r", "__q"]
    left = left.select(*cell, "query_id", "query_vector")
    right = right.select(*cell, *exprs, "values", *extra)
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("score", T.DoubleType()),
            *fields,
        ]
    )
    empty = pa.schema(_arrow_schema(schema))

    def block(q: pa.Table, rows: pa.Table) -> pa.Table:
        rows = of_dim(rows.combine_chunks(), dim)
        if q.num_rows == 0 or rows.num_rows == 0:
            return empty.empty_table()
        state = Scan(metric, to_matrix(q["query_vector"], dim), k, id_cols)
        state.add(rows)
        return state.result(q["query_id"].combine_chunks())

    hits = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(block, schema)
    return nested_id(hits, corpus)


def _arrow_schema(schema: T.StructType) -> list:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(schema))


def one_length(head: pa.Table, queries: DataFrame, held: int) -> int:
    """The length of all query vectors, of which ``head`` has the first; different ones are an error."""
    sizes = set(pc.list_value_length(head["query_vector"]).to_pylist())
    if head.num_rows > held:
        sizes |= {r[0] for r in queries.select(F.size("query_vector")).distinct().limit(2).collect()}
    if len(sizes) > 1:
        raise ValueError(f"query vectors of different lengths: {sorted(sizes)}")
    return sizes.pop()


def no_hits(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """The result of a search without queries."""
    fields = [queries.schema["query_id"], T.StructField("rank", T.IntegerType()), corpus.schema["id"]]
    return queries.sparkSession.createDataFrame([], T.StructType([*fields, T.StructField("score", T.DoubleType())]))


def vector_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = DEFAULT_TOP_K,
    metric: str = "cosine",
    strategy: str = "auto",
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Exact top-k: ``query_id, rank, id, score``, higher scores first.

    Metrics: ``cosine``, ``dot`` and ``l2`` (negated distance). Filter the corpus before the
    call to search a subset of it; rows of another dimension than the queries, and rows with a null
    or non-finite element, do not match. A column ``top_k`` of the queries comes before ``k``; null
    and 0 mean ``k``. Without queries there are no hits.
    ``strategy`` is ``broadcast``, ``grid`` or ``auto`` (by the measured size of the queries).
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    if strategy not in ("auto", "broadcast", "grid"):
        raise ValueError(f"unknown strategy {strategy!r}")
    wanted = queries.where(F.col("query_vector").isNotNull())
    corpus = corpus.select("id", "values", *[c for c in corpus.columns if c == "scale"])
    head = wanted.select("query_id", "query_vector").limit(query_rows + 1).toArrow()
    if head.num_rows == 0:
        return no_hits(queries, corpus)
    dim = one_length(head, wanted, query_rows)
    depth = deepest(wanted, k)
    fits = head.num_rows <= query_rows and head.num_rows * dim * 8 <= QUERY_BYTES
    if strategy == "broadcast" and not fits:
        raise ValueError("the queries exceed the broadcast budget")
    if fits and strategy != "grid":
        hits = _broadcast_scan(head, corpus, queries.schema["query_id"].dataType, depth, metric)
    else:
        hits = grid_scan(wanted, corpus, depth, metric, dim)
    ranked = rank_hits(hits, depth).select("query_id", "rank", "id", "score")
    return limit_per_query(ranked, queries, k)
