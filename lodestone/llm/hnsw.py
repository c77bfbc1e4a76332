"""Embedding near-duplicates over navigable small-world graphs, one per shard.

Vectors of one label and length are dealt by hash into shards of about ``SHARD``. In each shard a
task builds a hierarchical navigable small-world graph: points are inserted in batches, each finds
its neighbours in the graph so far from the top layer down, keeps diverse ones, and is linked back.
Every vector then queries every shard of its label, in blocks of ``QUERIES``: a beam descends
through the layers and widens on the lowest one while its worst member is still a link. An audit
compares ``AUDIT`` queries of each block with all vectors of the shard, and the beam of the whole
block doubles until the recall of links is at least ``RECALL``; a beam as wide as the shard looks
at everything. Links are verified by cosine in double precision. A block sends each query's number
of links and a spanning forest of them, never all pairs, and components are unions over all blocks.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
label, link with nothing. Rows that repeat an id are vectors of their own. A null id is no
component id; a component has the smallest of its other ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import stored
from lodestone.llm.components import components

COSINE = 0.93
SHARD = 8_192
QUERIES = 4_096
#: Links of a point per layer (twice as many on the lowest), beams, and the audit.
LINKS, BUILD_BEAM, BEAM = 16, 48, 64
AUDIT, RECALL = 32, 0.995
SLACK = 1e-3

VECTORS = "node long, label int, size int, values array<float>"


class Graph:
    """A small world over unit vectors: per layer the neighbours of each point, -1 where there are fewer."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray], top: np.ndarray):
        self.unit, self.layers, self.top = unit, layers, top

    @classmethod
    def build(cls, unit: np.ndarray) -> Graph:
        n = len(unit)
        rng = np.random.default_rng(n)
        level = np.minimum(-np.log(rng.random(n)) / np.log(LINKS), 6).astype(int)
        level[0] = level.max()
        layers = [np.full((n, LINKS * (2 if l == 0 else 1)), -1, np.int32) for l in range(level.max() + 1)]
        graph = cls(unit, layers, np.array([0]))
        start = 1
        while start < n:
            new = np.arange(start, min(start + max(1, min(start // 2, 256)), n))
            pool = np.zeros((len(new), 1), np.int64)
            for l in range(len(layers) - 1, -1, -1):
                pool, _ = graph.beam(l, unit[new], pool, BUILD_BEAM if l <= level[new].max() else 1)
                here = new[level[new] >= l]
                if len(here):
                    mates = np.broadcast_to(here, (len(here), len(here)))
                    graph.insert(l, here, np.concatenate([pool[level[new] >= l], mates], axis=1))
            start = new[-1] + 1
        return graph

    def insert(self, layer: int, points: np.ndarray, found: np.ndarray) -> None:
        """Link points with diverse ones among those found, and these back."""
        links = self.layers[layer]
        chosen = self.diverse(points, found, LINKS)
        links[points, : chosen.shape[1]] = chosen
        back = np.repeat(points, chosen.shape[1])[chosen.ravel() >= 0]
        ends = chosen.ravel()[chosen.ravel() >= 0]
        order = np.argsort(ends, kind="stable")
        ends, back = ends[order], back[order]
        owners, at, count = np.unique(ends, return_index=True, return_counts=True)
        more = np.full((len(owners), count.max(initial=0)), -1, np.int64)
        more[np.repeat(np.arange(len(owners)), count), np.arange(len(ends)) - np.repeat(at, count)] = back
        links[owners] = self.diverse(owners, np.concatenate([links[owners], more], axis=1), links.shape[1], fill=True)

    def diverse(self, points: np.ndarray, found: np.ndarray, most: int, fill: bool = False) -> np.ndarray:
        """Up to ``most`` of those found per point, nearest first, leaving out those nearer to a chosen one.

        With ``fill``, places left over take the nearest of the others.
        """
        out = np.full((len(points), most), -1, np.int64)
        for s in range(0, len(points), 256):
            rows, ids = points[s : s + 256], np.sort(found[s : s + 256], axis=1)
            ids = np.where((ids == rows[:, None]) | np.pad(ids[:, 1:] == ids[:, :-1], ((0, 0), (1, 0))), -1, ids)
            sims = np.where(ids >= 0, np.einsum("rd,rkd->rk", self.unit[rows], self.unit[ids]), -2)
            order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * BUILD_BEAM]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            near = self.unit[ids]
            among = near @ near.transpose(0, 2, 1)
            kept, full = np.zeros(ids.shape, bool), np.zeros(len(rows), int)
            for k in range(ids.shape[1]):
                hidden = (kept & (among[:, k] > sims[:, k : k + 1])).any(axis=1)
                kept[:, k] = (ids[:, k] >= 0) & ~hidden & (full < most)
                full += kept[:, k]
            rank = np.where(kept, 0, np.where((ids >= 0) & fill, 1, 2))
            order = np.argsort(rank, axis=1, kind="stable")[:, :most]
            picked = np.where(np.take_along_axis(rank, order, 1) < 2, np.take_along_axis(ids, order, 1), -1)
            out[s : s + 256, : picked.shape[1]] = picked
        return out

    def beam(self, layer: int, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest points met from ``start`` on a layer: ids, -1 filled, and cosines, best first."""
        links, n = self.layers[layer], len(self.unit)
        step = max(1, width // 16)
        ids = np.full((len(queries), max(width, 1)), -1, np.int64)
        sims = np.full(ids.shape, -2.0, np.float32)
        done = np.ones(ids.shape, bool)
        seen = np.zeros((len(queries), n + 1), bool)
        active, fresh = np.arange(len(queries)), start
        while len(active):
            fresh = np.sort(fresh, axis=1)
            fresh = np.where(np.pad(fresh[:, 1:] == fresh[:, :-1], ((0, 0), (1, 0))), -1, fresh)
            fresh = np.where(seen[active[:, None], fresh], -1, fresh)
            seen[active[:, None], fresh] = True
            seen[:, n] = False
            got = np.where(fresh >= 0, np.einsum("rd,rkd->rk", queries[active], self.unit[fresh]), -2)
            all_ids = np.concatenate([ids[active], fresh], axis=1)
            all_sims = np.concatenate([sims[active], got], axis=1)
            all_done = np.concatenate([done[active], fresh < 0], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, : ids.shape[1]]
            ids[active], sims[active] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
            done[active] = np.take_along_axis(all_done, order, 1)
            due = ~done[active]
            due &= np.cumsum(due, axis=1) <= step
            some = due.any(axis=1)
            active, due = active[some], due[some]
            if not len(active):
                break
            order = np.argsort(~due, axis=1, kind="stable")[:, :step]
            take = np.take_along_axis(due, order, 1)
            nodes = np.where(take, np.take_along_axis(ids[active], order, 1), -1)
            flags = done[active]
            flags[due] = True
            done[active] = flags
            fresh = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(active), -1)
        return ids, sims

    def search(self, queries: np.ndarray, width: int, least: float) -> list[np.ndarray]:
        """Per query the points found with at least a cosine of ``least``; the beam widens while it is full of them."""
        n = len(self.unit)
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        due = np.arange(len(queries))
        while len(due):
            part = max(8, 65_536 // max(width, 64))
            full = []
            for s in range(0, len(due), part):
                rows = due[s : s + part]
                if width >= n:
                    sims = queries[rows] @ self.unit.T
                    for r, near in zip(rows, sims >= least):
                        out[r] = np.nonzero(near)[0]
                    continue
                pool = np.broadcast_to(self.top, (len(rows), len(self.top)))
                for l in range(len(self.layers) - 1, 0, -1):
                    pool, _ = self.beam(l, queries[rows], pool, max(4, width // 8))
                pool, sims = self.beam(0, queries[rows], pool, width)
                for r, found, sim in zip(rows, pool, sims):
                    out[r] = found[sim >= least]
                full.append(rows[sims[:, -1] >= least])
            due = np.concatenate(full) if full else due[:0]
            width *= 4
        return out


def audited(graph: Graph, queries: np.ndarray, least: float) -> list[np.ndarray]:
    """Search with a beam that doubles until the audit passes."""
    width, n = BEAM, len(graph.unit)
    tests = np.unique(np.linspace(0, len(queries) - 1, AUDIT).astype(int))
    truth = [np.nonzero(row)[0] for row in queries[tests] @ graph.unit.T >= least]
    while True:
        found = graph.search(queries, width, least)
        there = sum(map(len, truth))
        met = sum(len(np.intersect1d(t, found[i])) for t, i in zip(truth, tests))
        if met >= RECALL * there or width >= n:
            return found
        width *= 2


def unit_rows(values: np.ndarray) -> np.ndarray:
    return (values / np.linalg.norm(values, axis=1, keepdims=True)).astype(np.float32)


def link_block(stacked: np.ndarray, nodes: np.ndarray, graph: Graph, queries: np.ndarray, asking: np.ndarray, least: float) -> Iterator[tuple]:
    """Per query node: its links in the shard, and those of them that join components of the block."""
    found = audited(graph, unit_rows(queries), least - SLACK)
    names, place = np.unique(np.concatenate([nodes, asking]), return_inverse=True)
    label, at = np.arange(len(names)), place[: len(nodes)]
    length, mine = np.linalg.norm(stacked, axis=1), np.linalg.norm(queries, axis=1)
    for q, ids in enumerate(found):
        exact = (stacked[ids] @ queries[q]) / (length[ids] * mine[q]) >= least
        ids = ids[exact & (nodes[ids] != asking[q])]
        own = place[len(nodes) + q]
        met, first = np.unique(label[at[ids]], return_index=True)
        joins = ids[first[met != label[own]]]
        if len(joins):
            label[np.isin(label, met)] = label[own]
        yield int(asking[q]), len(ids), nodes[joins].tolist()


def usable(embeddings: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """All rows with a node number of their own; ``size`` is null for vectors that link with nothing."""
    values = F.col(vector).cast("array<float>")
    plain = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    good = F.coalesce(plain & F.exists(values, lambda x: x != 0) & F.col(label).isNotNull(), F.lit(False))
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), values.alias("values"), good.alias("good"))
    rows = rows.withColumns({"node": F.monotonically_increasing_id(), "size": F.when(F.col("good"), F.size("values"))})
    return stored(rows.drop("good"), "vectors")


def near_duplicates(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    rows = usable(embeddings, key, vector, label)
    good = rows.where("size IS NOT NULL")
    sizes = good.groupBy("label", "size").agg(F.count("*").alias("n"))
    sizes = stored(sizes.select("label", "size", F.ceil(F.col("n") / SHARD).alias("shards"), F.ceil(F.col("n") / QUERIES).alias("blocks")), "sizes")
    dealt = good.join(sizes, ["label", "size"])
    own = F.pmod(F.xxhash64("node"), F.col("shards")).alias("shard")
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).alias("block")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        stacked = np.stack(rows["values"]).astype(np.float64)
        graph = Graph.build(unit_rows(stacked))
        links = [[layer[i].tolist() if layer[i, 0] >= 0 else [] for layer in graph.layers] for i in range(len(rows))]
        return pd.DataFrame({"label": key[0], "size": key[1], "shard": key[2], "node": rows["node"], "values": rows["values"], "links": links})

    shape = "label int, size int, shard long, node long, values array<float>, links array<array<int>>"
    graphs = dealt.select("label", "size", own, "node", "values").groupBy("label", "size", "shard").applyInPandas(build, shape)
    graphs = stored(graphs, "graphs").join(sizes, ["label", "size"]).withColumn("block", every("blocks"))
    asking = dealt.select("label", "size", block, "node", "values", every("shards").alias("shard"))

    def ask(key: tuple, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(queries):
            return pd.DataFrame({"node": [], "n": [], "links": []})
        shard, queries = shard.sort_values("node"), queries.sort_values("node")
        stacked = np.stack(shard["values"]).astype(np.float64)
        layers = []
        for l in range(len(shard["links"].iloc[0])):
            layer = np.full((len(shard), LINKS * (2 if l == 0 else 1)), -1, np.int32)
            for i, x in enumerate(shard["links"]):
                layer[i, : len(x[l])] = x[l]
            layers.append(layer)
        graph = Graph(unit_rows(stacked), layers, np.array([0]))
        values = np.stack(queries["values"]).astype(np.float64)
        made = link_block(stacked, shard["node"].to_numpy(), graph, values, queries["node"].to_numpy(), least)
        return pd.DataFrame(made, columns=["node", "n", "links"])

    at = ("label", "size", "shard", "block")
    found = graphs.groupBy(*at).cogroup(asking.groupBy(*at)).applyInPandas(ask, "node long, n long, links array<long>")
    found = stored(found, "found")
    counts = found.groupBy("node").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("node").alias("a"), F.explode("links").alias("b")))
    rows = rows.select("node", "vec_id").join(counts, "node", "left").join(roots, "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    least_id = rows.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    rows = rows.join(least_id, "root")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
