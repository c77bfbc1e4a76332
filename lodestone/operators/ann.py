"""Approximate search: vectors in cells around centroids, int8 codes, one search with two knobs.

The layout is the published inverted-file scheme with scalar quantisation. Centroids are trained on
all vectors: every pass assigns each vector to its nearest centroid and sums the vectors per cell
inside the tasks, so only sums are shuffled. A centroid table beyond ``CENTROID_BYTES`` has two
levels: ``top`` cells whose centroids every task gets, and cells below them, to which the vectors
are sent by ``top``. An index is stored in one folder per ``top``, sorted by cell.

A search reads the folders of the probed cells in place: the queries go to the rows. Vectors that
are null, of another length, or not finite are kept in cell ``NO_CELL``, which no search probes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.vectors import int8_codes, pair_score, score_block, to_lists, to_matrix, usable
from lodestone.operators.dense import (
    BLOCK_CELLS,
    DEFAULT_TOP_K,
    QUERY_BYTES,
    QUERY_ROWS,
    Scan,
    block_shape,
    flat_id,
    grid_scan,
    nested_id,
    no_hits,
    of_dim,
    one_length,
    vector_search,
)
from lodestone.operators.topk import deepest, limit_per_query, rank_hits, with_rows
from lodestone.session import cut_lineage

CENTROID_BYTES = 128 << 20  # largest centroid matrix sent to every task
FOLDERS = 1_024  # most folders of an index whose centroids have one level
FILE_ROWS = 1_000_000  # rows of one file of an index
ROUTE_ROWS = 200_000  # rows of a top cell that one task assigns
PASSES, ROUTED_PASSES = 10, 4
DEFAULT_NPROBE = 8
NO_CELL = -1

SUMS = "cell bigint, n bigint, total array<double>"


def centroids_fit(centroids: DataFrame, dim: int) -> bool:
    """Whether a centroid table may be sent to every task."""
    most = CENTROID_BYTES // (8 * dim)
    return centroids.limit(most + 1).count() <= most


def common_dim(vectors: DataFrame) -> tuple[int, int]:
    """The most common vector length, and how many vectors have it."""
    sizes = vectors.where("values IS NOT NULL").groupBy(F.size("values").alias("dim")).count()
    found = sizes.orderBy(F.desc("count"), "dim").first()
    if found is None or found["dim"] == 0:
        raise ValueError("no vectors")
    return found["dim"], found["count"]


class Centroids:
    """A bounded centroid table as unit vectors, ordered by cell."""

    def __init__(self, cells: np.ndarray, tops: np.ndarray, matrix: np.ndarray):
        order = np.argsort(cells, kind="stable")
        self.cells, self.tops, self.matrix = cells[order], tops[order], matrix[order]
        norms = np.sqrt((self.matrix**2).sum(1, keepdims=True))
        self.unit = np.divide(self.matrix, norms, out=np.zeros_like(self.matrix), where=norms > 0)

    @classmethod
    def of(cls, table: pa.Table) -> "Centroids":
        cells = table["cell"].to_numpy().astype(np.int64)
        tops = table["top"].to_numpy() if "top" in table.column_names else cells % FOLDERS
        return cls(cells, tops.astype(np.int64), to_matrix(table["centroid"], len(table["centroid"][0])))

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        """Place of the centroid with the largest cosine; the lower cell wins a tie to 6 decimals."""
        step = max(1, BLOCK_CELLS // len(self.unit))
        best = [np.zeros(0, dtype=np.int64)]
        for start in range(0, len(rows), step):
            part = unit_rows(rows[start : start + step])
            best.append(np.argmax(np.floor((part @ self.unit.T) * 1e6 + 0.5), axis=1))
        return np.concatenate(best)

    def sums(self, batches: Iterator[pa.Array]) -> pa.RecordBatch:
        """Per cell, how many vectors are nearest to it and the sum of their unit vectors."""
        count, total = np.zeros(len(self.cells), np.int64), np.zeros_like(self.unit)
        for values in batches:
            rows = to_matrix(values, self.unit.shape[1])
            place = self.nearest(rows)
            count += np.bincount(place, minlength=len(count))
            np.add.at(total, place, unit_rows(rows))
        met = np.flatnonzero(count)
        columns = [pa.array(self.cells[met]), pa.array(count[met]), to_lists(total[met], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["cell", "n", "total"])


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows**2).sum(1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def add_sums(partial: DataFrame) -> DataFrame:
    """Sums of all tasks per cell."""

    def add(rows: pa.Table) -> pa.Table:
        total = to_matrix(rows["total"], len(rows["total"][0])).sum(0)
        columns = [rows["cell"].slice(0, 1), pa.array([pc.sum(rows["n"]).as_py()]), to_lists(total[None, :], pa.float64())]
        return pa.table(dict(zip(("cell", "n", "total"), columns)))

    return partial.groupBy("cell").applyInArrow(add, SUMS)


def seed_rows(rows: DataFrame, n: int, seed: int) -> np.ndarray:
    """About ``n`` different vectors, chosen by the hash of their id; copies give one seed."""
    order = F.xxhash64("id", F.lit(seed))
    some = rows.select(F.col("values").cast("array<double>").alias("values"), order.alias("h")).orderBy("h").limit(2 * n).toArrow()
    matrix = to_matrix(some["values"], len(some["values"][0]))
    _, first = np.unique(matrix.round(9), axis=0, return_index=True)
    return matrix[np.sort(first)[:n]]


def average(rows: DataFrame, matrix: np.ndarray, passes: int) -> np.ndarray:
    """Lloyd's passes over all rows from the centroids ``matrix``; a cell left empty keeps its centroid."""
    for _ in range(passes):
        known = Centroids(np.arange(len(matrix)), np.zeros(len(matrix), np.int64), matrix)

        def partial(batches: Iterator[pa.RecordBatch], known: Centroids = known) -> Iterator[pa.RecordBatch]:
            yield known.sums(b.column(0) for b in batches)

        found = add_sums(rows.select("values").mapInArrow(partial, SUMS)).toArrow()  # a row per cell
        last, matrix = matrix, known.unit.copy()
        if found.num_rows:
            matrix[found["cell"].to_numpy()] = unit_rows(to_matrix(found["total"], matrix.shape[1]))
        if np.abs(matrix - unit_rows(last)).max() < 1e-6:
            break
    return matrix


def train_centroids(vectors: DataFrame, cells: int | None = None, seed: int = 7, passes: int = PASSES) -> DataFrame:
    """Centroids ``cell, top, centroid`` of all vectors of the most common length.

    The default number of cells is the square root of that of the vectors; there is no largest one.
    """
    dim, n = common_dim(vectors)
    rows = vectors.select("id", "values").where(usable(F.col("values"), dim))
    cells = min(cells or round(math.sqrt(n)), n)
    if cells < 1:
        raise ValueError("at least one cell is needed")
    spark, schema = vectors.sparkSession, "cell bigint, top int, centroid array<double>"
    if cells * dim * 8 <= CENTROID_BYTES:
        matrix = average(rows, seed_rows(rows, cells, seed), passes).round(6)
        return spark.createDataFrame([(i, i % FOLDERS, c.tolist()) for i, c in enumerate(matrix)], schema)
    tops = average(rows, seed_rows(rows, min(math.ceil(math.sqrt(cells)), CENTROID_BYTES // (8 * dim)), seed), passes)
    known = Centroids(np.arange(len(tops)), np.arange(len(tops)), tops)
    placed = with_top(rows, known)
    share = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)) < int(cells / n * (1 << 40))
    seeds = placed.where(share).dropDuplicates(["top", "values"])
    number = F.row_number().over(W.partitionBy("top").orderBy("id"))
    centroid = F.transform("values", lambda x: x.cast("double")).alias("centroid")
    found = seeds.select((F.shiftleft(F.col("top").cast("bigint"), 32) + number).alias("cell"), "top", centroid)
    found = cut_lineage(found)
    for _ in range(min(passes, ROUTED_PASSES)):
        sums = add_sums(routed(placed, found, lambda c, rows: c.sums([rows["values"].combine_chunks()]), SUMS))
        mean = F.transform("total", lambda x: F.round(x / F.col("n"), 6))
        moved = sums.select("cell", mean.alias("__m"))
        found = cut_lineage(found.join(moved, "cell", "left").select("cell", "top", F.coalesce("__m", "centroid").alias("centroid")))
    return found


def with_top(rows: DataFrame, tops: Centroids) -> DataFrame:
    @F.arrow_udf("int")
    def top(values: pa.Array) -> pa.Array:
        return pa.array(tops.cells[tops.nearest(to_matrix(values, tops.unit.shape[1]))], pa.int32())

    return rows.withColumn("top", top.asNondeterministic()("values"))


def routed(placed: DataFrame, centroids: DataFrame, work, schema: str | T.StructType) -> DataFrame:
    """Send vectors to the centroids below their top cell; top cells with many vectors are cut into parts."""
    parts = F.ceil(F.count("*") / F.lit(ROUTE_ROWS)).cast("int").alias("__parts")
    sizes = F.broadcast(placed.groupBy("top").agg(parts))  # a row per top cell
    left = placed.join(sizes, "top").withColumn("__s", F.pmod(F.xxhash64("id"), F.col("__parts")).cast("int"))
    right = centroids.join(sizes, "top").withColumn("__s", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    left, right = left.drop("__parts"), right.select("top", "__s", "cell", "centroid")

    def meet(rows: pa.Table, cells: pa.Table) -> pa.Table:
        if not rows.num_rows or not cells.num_rows:
            return empty.empty_table()
        out = work(Centroids.of(cells), rows)
        return pa.Table.from_batches([out]) if isinstance(out, pa.RecordBatch) else out

    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema)
    return left.groupBy("top", "__s").cogroup(right.groupBy("top", "__s")).applyInArrow(meet, schema)


def mean_centroids(vectors: DataFrame, by: str) -> DataFrame:
    """Centroids ``cell, centroid`` as the mean vector of each value of ``by``, to 6 decimals."""
    cells = vectors.select(F.col(by).cast("int").alias("cell"), F.posexplode_outer("values").alias("i", "x"))
    means = cells.where(F.col("i").isNotNull()).groupBy("cell", "i")
    means = means.agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    return means.groupBy("cell").agg(F.transform(ordered, lambda p: p["x"]).alias("centroid"))


def ann_build(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """Index rows: the vectors with their ``cell`` and ``top``, and int8 ``codes`` with a ``scale``.

    Vectors that can match nothing keep null codes and ``NO_CELL``.
    """
    head = centroids.select(F.size("centroid").alias("dim")).first()
    if head is None:
        raise ValueError("no centroids")
    dim = head["dim"]
    good = vectors.where(usable(F.col("values"), dim))
    bad = vectors.where(~usable(F.col("values"), dim))
    if centroids_fit(centroids, dim):
        known = Centroids.of(centroids.toArrow())

        @F.arrow_udf("struct<cell:bigint,top:int>")
        def place(values: pa.Array) -> pa.Array:
            at = known.nearest(to_matrix(values, dim))
            return pa.StructArray.from_arrays([pa.array(known.cells[at]), pa.array(known.tops[at], pa.int32())], ["cell", "top"])

        placed = good.withColumn("__p", place.asNondeterministic()("values"))
        placed = placed.withColumns({"cell": F.col("__p.cell"), "top": F.col("__p.top")}).drop("__p")
    else:
        means = mean_centroids(centroids.select("top", F.col("centroid").alias("values")), "top").toArrow()
        means = means.append_column("top", means["cell"])
        fields = [*good.schema.fields, T.StructField("top", T.IntegerType()), T.StructField("cell", T.LongType())]

        def nearest(cells: Centroids, rows: pa.Table) -> pa.Table:
            at = cells.nearest(to_matrix(rows["values"], dim))
            return rows.drop_columns(["__s"]).append_column("cell", pa.array(cells.cells[at]))

        placed = routed(with_top(good, Centroids.of(means)), centroids, nearest, T.StructType(fields))
    placed = placed.withColumn("__c", int8_codes(F.col("values")))
    placed = placed.withColumns({"codes": F.col("__c.codes"), "scale": F.col("__c.scale")}).drop("__c")
    none = {"cell": F.lit(NO_CELL).cast("bigint"), "top": F.lit(NO_CELL)}
    none |= {"codes": F.lit(None).cast("array<tinyint>"), "scale": F.lit(None).cast("double")}
    return placed.unionByName(bad.withColumns(none))


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Store an index in one folder per ``top``, each file sorted by cell, and read it back.

    A top cell is cut by its counted rows into files of about ``FILE_ROWS``.
    """
    index = index.withColumn("top", F.coalesce("top", F.lit(NO_CELL)))
    stored = cut_lineage(index)  # counted and written
    parts = F.ceil(F.count("*") / F.lit(FILE_ROWS)).cast("int").alias("__parts")
    sizes = F.broadcast(stored.groupBy("top").agg(parts))  # a row per top cell
    salted = stored.join(sizes, "top").withColumn("__s", F.pmod(F.xxhash64("id"), F.col("__parts"))).drop("__parts")
    rows = salted.repartition("top", "__s").drop("__s").sortWithinPartitions("top", "cell", "id")
    rows.write.mode(mode).partitionBy("top").parquet(path)
    return index.sparkSession.read.parquet(path)


def probes_of(queries: pa.Table, plain: DataFrame, centroids: DataFrame, nprobe: int) -> tuple[dict[int, np.ndarray], set[int]]:
    """For each probed cell the places of the queries that probe it, and the probed top cells."""
    dim = len(queries["query_vector"][0])
    if centroids_fit(centroids, dim):
        known = Centroids.of(centroids.toArrow())
        if known.matrix.shape[1] != dim:
            raise ValueError(f"queries of {dim} values, centroids of {known.matrix.shape[1]}")
        scores = score_block("cosine", known.matrix, to_matrix(queries["query_vector"], dim))
        near = np.argsort(-scores, axis=0, kind="stable")[:nprobe]
        pairs = [(int(known.cells[c]), int(known.tops[c]), q) for q in range(near.shape[1]) for c in near[:, q]]
    else:  # at most nprobe rows for each of a bounded number of queries
        as_corpus = centroids.select(F.struct("cell", "top").alias("id"), F.col("centroid").alias("values"))
        place = {v: i for i, v in enumerate(queries["query_id"].to_pylist())}
        hits = vector_search(plain, as_corpus, nprobe).select("query_id", "id.cell", "id.top").toArrow()
        pairs = [(r["cell"], r["top"], place[r["query_id"]]) for r in hits.to_pylist()]
    cells: dict[int, list[int]] = {}
    for cell, _, query in pairs:
        cells.setdefault(cell, []).append(query)
    return {c: np.array(q) for c, q in cells.items()}, {t for _, t, _ in pairs}


def scan_cells(queries: pa.Table, query_id_type: T.DataType, rows: DataFrame, cells: dict[int, np.ndarray], k: int, metric: str) -> DataFrame:
    """Top-k per query and task over ``id, values [, scale], cell``, each row scored by its cell's queries only."""
    exprs, fields, id_cols = flat_id(rows)
    dim = len(queries["query_vector"][0])
    matrix, query_ids = to_matrix(queries["query_vector"], dim), queries["query_id"].combine_chunks()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Scan(metric, matrix, k, id_cols)
        for batch in batches:
            batch = of_dim(batch, dim)
            here = batch.column("cell").to_numpy(zero_copy_only=False)
            for cell in np.unique(here):
                if cell in cells:
                    state.add(batch.filter(pa.array(here == cell)), cells[cell])
        out = state.result(query_ids)
        if out is not None:
            yield from out.combine_chunks().to_batches()

    schema = T.StructType([T.StructField("query_id", query_id_type), T.StructField("score", T.DoubleType()), *fields])
    extra = [c for c in ("scale",) if c in rows.columns]
    return nested_id(rows.select(*exprs, "values", *extra, "cell").mapInArrow(scan, schema), rows)


def ann_search(
    queries: DataFrame,
    index: DataFrame,
    centroids: DataFrame,
    k: int = DEFAULT_TOP_K,
    nprobe: int = 0,
    depth: int = 0,
    metric: str = "cosine",
    query_rows: int = QUERY_ROWS,
    block_rows: int | None = None,
    block_queries: int | None = None,
) -> DataFrame:
    """Top-k among the ``nprobe`` nearest cells of each query; 0 means the default.

    With a ``depth`` the probed rows are scored by their int8 codes, and only the best ``depth`` of
    each query by their vectors; without one all probed vectors are scored. Queries are sent to
    the rows, whose folders are read in place; a batch beyond the budget meets them by cell on a
    grid of bounded blocks instead. Probing every cell gives the exact result, at a depth of all rows too.
    """
    nprobe = nprobe or DEFAULT_NPROBE
    wanted = queries.where("query_vector IS NOT NULL").select("query_id", "query_vector", *[c for c in ("top_k",) if c in queries.columns])
    head = wanted.select("query_id", "query_vector").limit(query_rows + 1).toArrow()
    if head.num_rows == 0:
        return no_hits(queries, index)
    dim = one_length(head, wanted, query_rows)
    most = deepest(wanted, k)
    codes = max(depth, most) if depth else 0
    plain, kind = wanted.select("query_id", "query_vector"), queries.schema["query_id"].dataType
    if head.num_rows <= query_rows and head.num_rows * dim * 8 <= QUERY_BYTES:
        cells, tops = probes_of(head, plain, centroids, nprobe)
        rows = index.where(F.col("top").isin(sorted(tops))) if "top" in index.columns else index
        if "top" not in index.columns or len(tops) < len(cells):  # cells that share folders
            probed = queries.sparkSession.createDataFrame([(int(c),) for c in cells], "cell bigint")
            rows = rows.withColumn("cell", F.col("cell").cast("bigint")).join(F.broadcast(probed), "cell", "left_semi")
        scored = rows.select("id", F.col("codes").alias("values"), "scale", "cell") if codes else rows.select("id", "values", "cell")
        hits = scan_cells(head, kind, scored, cells, codes or most, metric)
    else:
        rows, hits = _grid_by_cell(plain, index, centroids, nprobe, codes, most, metric, dim, block_rows, block_queries)
    if codes:
        coarse = rank_hits(hits, codes).select("query_id", "id")
        exact = with_rows(coarse, rows.select("id", "values")).join(plain, "query_id")
        hits = exact.select("query_id", "id", pair_score(metric, F.col("values"), F.col("query_vector")).alias("score"))
    return limit_per_query(rank_hits(hits, most).select("query_id", "rank", "id", "score"), queries, k)


def _grid_by_cell(plain, index, centroids, nprobe, codes, most, metric, dim, block_rows, block_queries):
    """A large batch of queries: both sides are cut by cell into bounded blocks; codes travel, not vectors, if there is a depth."""
    as_corpus = centroids.select(F.col("cell").cast("bigint").alias("id"), F.col("centroid").alias("values"))
    near = vector_search(plain, as_corpus, nprobe).select("query_id", F.col("id").alias("cell"))
    probes = cut_lineage(plain.join(near, "query_id"))
    rows = index.withColumn("cell", F.col("cell").cast("bigint"))
    scored = rows.select("id", F.col("codes").alias("values"), "scale", "cell") if codes else rows.select("id", "values", "cell")
    block_rows, block_queries = block_shape(dim, block_rows, block_queries)
    asked = probes.groupBy("cell").agg(F.count("*").alias("q"))
    salts = rows.groupBy("cell").agg(F.count("*").alias("n")).join(asked, "cell").select(
        "cell",
        F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("row_salts"),
        F.ceil(F.col("q") / F.lit(block_queries)).cast("int").alias("query_salts"),
    )
    salts = cut_lineage(salts)
    if centroids_fit(centroids, dim):
        salts = F.broadcast(salts)
    return rows, grid_scan(probes, scored, codes or most, metric, dim, "cell", salts)


def rerank_depth_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = DEFAULT_TOP_K,
    depth: int = 0,
    metric: str = "cosine",
) -> DataFrame:
    """Score all int8 codes, keep ``depth`` candidates per query, score those exactly.

    Depth 0 means 10k, at least 100. The full vectors are read only for the candidates. With an
    index of cells, ``ann_search`` takes a depth and scores the codes of the probed cells only.
    """
    most = deepest(queries, k)
    depth = max(depth or max(10 * most, 100), most)
    codes = index.select("id", F.col("codes").alias("values"), "scale")
    coarse = vector_search(queries.drop("top_k"), codes, depth, "dot").select("query_id", "id")
    exact = (
        with_rows(coarse, index.select("id", "values"))
        .join(queries.select("query_id", "query_vector"), "query_id")
        .select("query_id", "id", pair_score(metric, F.col("values"), F.col("query_vector")).alias("score"))
    )
    return limit_per_query(rank_hits(exact, most).select("query_id", "rank", "id", "score"), queries, k)
