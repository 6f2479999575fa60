"""Approximate nearest neighbours on robust-pruned directed graphs, one to a shard.

Distinct pairs of an id and a vector are dealt into shards of a bounded size by
a hash of both, so that an id of many vectors is in many shards. Within
a shard, a greedy beam search from the most central vector proposes neighbours
for each vector, and relaxed distance pruning keeps a diverse few of them: a
proposal goes if one already kept is much nearer to it than the vector is. Edges
are added both ways. Every query is searched in every shard, and its nearest
are those of all shards. A shard answers with distinct ids; if the nodes that a
search ends with have too few, all of the shard's are ranked. Searches of many vectors advance together as arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm.common import stored

SHARD_ROWS = 16384
QUERIES_AT_ONCE = 2048
DEGREE = 24
BEAM = 64
RELAXED = 1.2


class Graph:
    """Out-edges between distinct vectors; -1 fills rows up."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE):
        # Single precision holds differences only about the middle and in the scale of these vectors; both are medians,
        # which a few far vectors don't move.
        self.middle = np.median(x, axis=0)
        apart = np.abs(x - self.middle).max(axis=1)
        self.scale = float(np.median(apart)) or float(apart.max()) or 1.0
        self.x = self.own(x)
        with np.errstate(over="ignore"):
            self.square = (self.x.astype(np.float64) ** 2).sum(axis=1).astype(np.float32)
        self.degree = degree
        self.edges = np.full((len(x), degree + degree // 2), -1, dtype=np.int32)
        with np.errstate(over="ignore", invalid="ignore"):
            from_middle = np.nan_to_num((self.x**2).sum(axis=1), nan=np.inf)
        self.start = int(from_middle.argmin())

    def own(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors as the graph compares them."""
        with np.errstate(over="ignore"):
            return np.ascontiguousarray((vectors - self.middle) / self.scale, dtype=np.float32)

    def search(self, queries: np.ndarray, beam: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The nodes (and squared distances) that beam search ends with, nearest first; -1 fills up."""
        many = len(queries)
        ids = np.full((many, beam), -1, dtype=np.int64)
        near = np.full((many, beam), np.inf, dtype=np.float32)
        done = np.zeros((many, beam), dtype=bool)
        ids[:, 0] = self.start
        near[:, 0] = self._distance(queries, ids[:, :1])[:, 0]
        rows = np.arange(many)
        while len(rows):
            mine, open_ = ids[rows], (ids[rows] >= 0) & ~done[rows]
            turn = np.cumsum(open_, axis=1)
            step = open_ & (turn <= at_once)  # the nearest that have not been looked at
            done[rows] |= step
            line, column = np.nonzero(step)
            fresh = np.full((len(rows), at_once * self.edges.shape[1]), -1, dtype=np.int64)
            fresh.reshape(len(rows), at_once, -1)[line, turn[line, column] - 1] = self.edges[mine[line, column]]
            fresh.sort(axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            seen = (fresh[:, :, None] == mine[:, None, :]).any(axis=2)
            fresh[seen] = -1
            distance = self._distance(queries[rows], fresh)
            all_ids = np.concatenate([mine, fresh], axis=1)
            all_near = np.concatenate([near[rows], distance], axis=1)
            all_done = np.concatenate([done[rows], np.zeros(fresh.shape, dtype=bool)], axis=1)
            best = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            near[rows] = np.take_along_axis(all_near, best, 1)
            done[rows] = np.take_along_axis(all_done, best, 1)
            ids[rows] = np.where(np.isinf(near[rows]), -1, ids[rows])
            rows = rows[((ids[rows] >= 0) & ~done[rows]).any(axis=1)]
        return ids, near

    def _distance(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):  # of vectors far away: infinite
            products = np.einsum("nkd,nd->nk", self.x[ids], queries, optimize=True)
            square = (queries**2).sum(axis=1)[:, None]
            near = np.nan_to_num(self.square[ids] - 2 * products + square, nan=np.inf, posinf=np.inf)
        return np.where(ids < 0, np.inf, np.maximum(near, 0)).astype(np.float32)

    def prune(self, nodes: np.ndarray, proposed: np.ndarray, relaxed: float = RELAXED) -> np.ndarray:
        """At most `degree` of each node's proposals (-1: none), nearest first, that no kept one stands before."""
        proposed = np.sort(proposed, axis=1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
        proposed[proposed == nodes[:, None]] = -1
        near = self._distance(self.x[nodes], proposed)
        order = np.argsort(near, axis=1, kind="stable")
        ids, near = np.take_along_axis(proposed, order, 1), np.take_along_axis(near, order, 1)
        points = self.x[ids]
        square = self.square[ids]
        with np.errstate(over="ignore", invalid="ignore"):
            between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
        alive = ~np.isinf(near)
        kept = np.full((len(nodes), self.degree), -1, dtype=np.int64)
        rows = np.arange(len(nodes))
        for k in range(self.degree):
            pick = alive.argmax(axis=1)
            has = alive[rows, pick]
            if not has.any():
                break
            kept[:, k] = np.where(has, ids[rows, pick], -1)
            alive &= ~(has[:, None] & (relaxed**2 * between[rows, pick] <= near))
            alive[rows, pick] = False
        return kept

    def build(self, beam: int = BEAM, batch: int = 256, seed: int = 3) -> Graph:
        n = len(self.x)
        random = np.random.default_rng(seed)
        few = min(self.degree // 2, n - 1)
        if few > 0:  # a random graph to begin with
            first = random.integers(0, n - 1, (n, few))
            self.edges[:, :few] = first + (first >= np.arange(n)[:, None])
        for relaxed in (1.0, RELAXED):
            order = random.permutation(n)
            for a in range(0, n, batch):
                nodes = order[a : a + batch]
                found, _ = self.search(self.x[nodes], beam)
                kept = self.prune(nodes, np.concatenate([found, self.edges[nodes]], axis=1), relaxed)
                self.edges[nodes] = -1
                self.edges[nodes, : self.degree] = kept
                self._back(nodes, kept, relaxed)
        return self

    def _back(self, nodes: np.ndarray, kept: np.ndarray, relaxed: float) -> None:
        """The same edges the other way round; a node whose row is full is pruned."""
        line, column = np.nonzero(kept >= 0)
        target, source = kept[line, column], nodes[line]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        to, start, many = np.unique(target, return_index=True, return_counts=True)
        new = np.full((len(to), int(many.max(initial=0))), -1, dtype=np.int64)
        new[np.repeat(np.arange(len(to)), many), np.arange(len(target)) - np.repeat(start, many)] = source
        both = np.concatenate([self.edges[to].astype(np.int64), new], axis=1)
        both = -np.sort(-both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both = -np.sort(-both, axis=1)
        width = self.edges.shape[1]
        full = (both >= 0).sum(axis=1) > width
        fits = both[:, :width] if both.shape[1] >= width else np.pad(both, ((0, 0), (0, width - both.shape[1])), constant_values=-1)
        self.edges[to[~full]] = fits[~full]
        for a in range(0, int(full.sum()), 256):
            part = np.flatnonzero(full)[a : a + 256]
            self.edges[to[part]] = -1
            self.edges[to[part], : self.degree] = self.prune(to[part], both[part], relaxed)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a finite vector other than zero, as vec_id and an array of doubles."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine & some).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("size")
    )


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """One row for each shard (and number of components): its ids, its distinct vectors and their edges, as bytes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        size = key[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        distinct, node = np.unique(flat.reshape(-1, size), axis=0, return_inverse=True)
        graph = Graph(distinct).build()
        return pa.Table.from_pydict(
            {
                "size": pa.array([size], pa.int32()),
                "shard": pa.array([key[1].as_py()], pa.int64()),
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "node": pa.array([node.astype("<i4").tobytes()], pa.binary()),
                "x": pa.array([distinct.astype("<f8").tobytes()], pa.binary()),
                "edges": pa.array([graph.edges.astype("<i4").tobytes()], pa.binary()),
            }
        )

    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))
    schema = "size int, shard long, ids binary, node binary, x binary, edges binary"
    return rows.withColumn("shard", shard).groupBy("size", "shard").applyInArrow(run, schema)


def _search_shard(key: tuple, index: pa.Table, asked: pa.Table, k: int, beam: int) -> pa.Table:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not index.num_rows or not asked.num_rows:
        return schema.empty_table()
    row, size = index.to_pylist()[0], key[0].as_py()
    x = np.frombuffer(row["x"], "<f8").reshape(-1, size)
    graph = Graph(x)
    graph.edges = np.frombuffer(row["edges"], "<i4").reshape(len(x), -1).copy()
    ids, node = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["node"], "<i4")
    order = np.lexsort((ids, node))  # each node's ids, the smallest first
    ids, first = ids[order], np.searchsorted(node[order], np.arange(len(x) + 1))

    def best(q: int, query: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Of ids under one node no more than k and the query itself can count.
        each = [ids[first[n] : min(first[n + 1], first[n] + k + 1)] for n in nodes]
        score = np.sqrt(((x[nodes] - query) ** 2).sum(axis=1)).repeat([len(e) for e in each])
        candidates = np.concatenate([ids[:0], *each])
        score, candidates = score[candidates != q], candidates[candidates != q]
        ranked = np.lexsort((candidates, score))
        _, nearest_of = np.unique(candidates[ranked], return_index=True)  # each id once, where it is nearest
        ranked = ranked[np.sort(nearest_of)[:k]]
        return candidates[ranked], score[ranked]

    query_ids = asked.column("vec_id").to_numpy()
    queries = asked.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    out: list[list] = [[], [], []]
    for a in range(0, len(queries), 256):
        part = queries[a : a + 256]
        found, _ = graph.search(graph.own(part), beam)
        for q, query, nodes in zip(query_ids[a : a + 256].tolist(), part, found, strict=True):
            nodes = nodes[nodes >= 0]
            near, score = best(q, query, nodes)
            if len(near) < k and len(nodes) < len(x):
                near, score = best(q, query, np.arange(len(x)))
            out[0] += [q] * len(near)
            out[1] += near.tolist()
            out[2] += score.tolist()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    shard_rows: int = SHARD_ROWS,
    beam: int = 128,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Each query's k nearest found: query_id, rank (from 1), vec_id, score (Euclidean distance in doubles).

    Ties go to the smaller vec_id; a query's own id is no candidate, and fewer
    than k candidates are all returned. Neighbours are looked for in single precision about
    the middle of each shard and in its scale, so offsets and scales common to its vectors
    cost nothing; a query that is far from all of a shard is compared with each vector there.
    Vectors that are null, zero or hold null
    or non-finite components take no part, as query or candidate, nor do rows
    without an id; vectors of different lengths never meet. Rows that repeat an
    id count once, where they are nearest. Empty tables give no rows.

    The index is written to the shared folder. A shard holds about shard_rows
    vectors; shards meet queries in blocks, so that no task sees all of either.
    """
    spark = vectors.sparkSession
    rows, asked = usable(vectors, id_col, vector_col).distinct(), usable(queries, id_col, vector_col).distinct()
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // QUERIES_AT_ONCE))
    index = stored(build_index(rows, shards), "graphs")
    per_block = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    per_shard = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    )
    key = ["size", "shard", "block"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_shard(key, left, right, k, beam)

    found = (
        per_block.groupBy(*key)
        .cogroup(per_shard.groupBy(*key))
        .applyInArrow(run, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
