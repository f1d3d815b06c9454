"""Approximate nearest neighbours by cosine over robust-pruned directed graphs.

Distinct vectors are dealt to shards of bounded size.  Each shard is one
directed graph: vectors enter in batches that grow with it, greedy beam
searches from the shard's medoid propose their neighbours, and robust pruning
keeps an edge only if no kept neighbour is closer to the proposed one by the
factor ``alpha`` (edges into all directions survive, so beams get out of
dense places).  A second round searches and prunes every vector again.  The
index is a written table, one row a vector with its out-edges.

A search sends every query to all shards of its length: a task reads the
graph of one shard once and runs the queries through it in blocks, beams side
by side.  What beams find is scored again in double precision, and the
nearest of all shards are kept per query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch

_INDEX = "dim int, shard int, node int, ids array<long>, vec array<double>, edges array<int>, entry boolean"
_ROUNDS = ((1.0, False), (1.2, True))        # alpha of each round, and whether every vector is searched again


@dataclass
class VectorIndex:
    """``nodes``: dim, shard, node, ids (smallest ids of the rows with this vector), vec, edges, entry."""

    scratch: Scratch
    nodes: DataFrame
    shards: int
    copies: int


def usable(vec) -> Column:
    """A vector with a direction: not null, only finite components, not all of them zero."""
    v = F.col(vec) if isinstance(vec, str) else vec
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the usable rows, one an id: of rows that share an id the smallest vector counts."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.filter(F.col("id").isNotNull() & usable("vec")).groupBy("id").agg(F.min("vec").alias("vec"))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine and keeps squares finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]).astype(np.float32)


class Graph:
    """Unit vectors with at most ``degree`` out-edges each (-1: none)."""

    def __init__(self, unit: np.ndarray, edges: np.ndarray, entry: int):
        self.x, self.edges, self.entry = unit, edges, entry
        self._seen = np.zeros((0, len(unit)), np.int32)

    def beam(self, queries: np.ndarray, width: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest vectors that greedy search meets, nearest first: (nodes or -1, squared distances)."""
        m, n = len(queries), len(self.x)
        if len(self._seen) < m:
            self._seen = np.zeros((m, n), np.int32)
        seen, rows = self._seen[:m], np.arange(m)
        seen[:] = -1                                             # the step's column that met a node first; -1: not met
        ids = np.full((m, width), -1, np.int64)
        dist = np.full((m, width), np.inf, np.float32)
        done = np.ones((m, width), bool)                         # nothing left to expand here
        ids[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = 2 - 2 * (queries @ self.x[self.entry])
        seen[:, self.entry] = 0
        live = rows
        while len(live):
            # the first unexpanded places of each beam (beams are sorted)
            rank = np.cumsum(~done[live], axis=1)
            pick = ~done[live] & (rank <= expand)
            r, c = np.nonzero(pick)
            done[live[r], c] = True
            near = np.full((len(live), expand, self.edges.shape[1]), -1, np.int64)
            near[r, rank[r, c] - 1] = self.edges[ids[live[r], c]]
            near = near.reshape(len(live), -1)
            new = (near >= 0) & (seen[live[:, None], near] < 0)
            i, j = np.nonzero(new)
            met = near[i, j]
            seen[live[i], met] = j                               # of a node met twice in one step the last stays
            one = seen[live[i], met] == j
            i, j, met = i[one], j[one], met[one]
            d = np.full(near.shape, np.inf, np.float32)
            d[i, j] = 2 - 2 * np.einsum("ij,ij->i", self.x[met], queries[live[i]])
            all_d = np.concatenate([dist[live], d], axis=1)
            all_i = np.concatenate([ids[live], near], axis=1)
            all_e = np.concatenate([done[live], d == np.inf], axis=1)
            best = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_d, best, 1), axis=1, kind="stable"), 1)
            dist[live] = np.take_along_axis(all_d, best, 1)
            ids[live] = np.take_along_axis(all_i, best, 1)
            done[live] = np.take_along_axis(all_e, best, 1)
            live = live[~done[live].all(axis=1)]
        ids[dist == np.inf] = -1
        return ids, dist


def robust_prune(x: np.ndarray, of: np.ndarray, cand: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """At most ``degree`` of the candidates (-1: none) of each vector ``of``, nearest first.

    Taking one drops every candidate that is closer to it, by the factor
    ``alpha``, than to the vector itself.
    """
    cand = np.where(cand == of[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1                # each candidate once
    d = np.where(cand >= 0, 2 - 2 * np.einsum("ijk,ik->ij", x[cand], x[of]), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    vec, rows = x[cand], np.arange(len(of))
    open_, out = np.isfinite(d), np.full((len(of), degree), -1, np.int64)
    for k in range(degree):
        if not open_.any():
            break
        at = open_.argmax(axis=1)
        has = open_[rows, at]
        out[has, k] = cand[rows, at][has]
        apart = 2 - 2 * np.einsum("ijk,ik->ij", vec, vec[rows, at])
        open_ &= ~(has[:, None] & (alpha * alpha * apart <= d))
        open_[rows, at] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = 24, beam: int = 48, block: int = 256) -> Graph:
    """The graph of one shard; the same vectors in the same order give the same graph."""
    x = _unit(vectors)
    n = len(x)
    mean = x.mean(axis=0)
    entry = int(np.argmin(((x - mean) ** 2).sum(axis=1)))
    graph = Graph(x, np.full((n, degree), -1, np.int64), entry)
    order = np.random.default_rng(n).permutation(n)
    order = order[order != entry]
    for alpha, again in _ROUNDS:
        lo = 0
        while lo < len(order):
            size = block if again else min(block, max(1, lo // 8))
            batch, lo = order[lo:lo + size], lo + size
            cand = np.concatenate([graph.beam(x[batch], beam)[0], graph.edges[batch]], axis=1)
            graph.edges[batch] = robust_prune(x, batch, cand, alpha, degree)
            _add_back(graph, batch, alpha, degree)
    return graph


def _add_back(graph: Graph, batch: np.ndarray, alpha: float, degree: int) -> None:
    """Edges back from the new neighbours; lists that grow beyond the degree are pruned."""
    to = graph.edges[batch]
    i, j = np.nonzero(to >= 0)
    target, source = to[i, j], batch[i]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, count)
    for part in range(0, len(nodes), 256):
        some = slice(part, part + 256)
        mine = np.repeat((np.arange(len(nodes)) >= part) & (np.arange(len(nodes)) < part + 256), count)
        wide = np.full((len(nodes[some]), degree + int(count[some].max())), -1, np.int64)
        wide[:, :degree] = graph.edges[nodes[some]]
        wide[np.repeat(np.arange(len(nodes[some])), count[some]), degree + place[mine]] = source[mine]
        kept = np.sort(wide, axis=1)
        kept[:, 1:][kept[:, 1:] == kept[:, :-1]] = -1
        full = (kept >= 0).sum(axis=1) > degree
        out = -np.sort(-kept, axis=1)[:, :degree]
        if full.any():
            out[full] = robust_prune(graph.x, nodes[some][full], kept[full], alpha, degree)
        graph.edges[nodes[some]] = out


def _shard_rows(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of equal first ``keys`` columns: (key, pieces of rows), a piece a batch."""
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        lo = 0
        for k in range(1, batch.num_rows + 1):
            if k == batch.num_rows or any(c[k] != c[lo] for c in cols[:keys]):
                yield tuple(c[lo] for c in cols[:keys]), [c[lo:k] for c in cols[keys:]]
                lo = k


def _build(degree: int, beam: int):
    def rows(key, ids, vecs) -> pa.RecordBatch:
        vectors = np.array(vecs, np.float64)
        order = np.argsort([i[0] for i in ids], kind="stable")
        vectors, ids = vectors[order], [ids[k] for k in order.tolist()]
        graph = build_graph(vectors, degree, beam)
        n = len(ids)
        edges = [[e for e in row if e >= 0] for row in graph.edges.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.int32()), pa.array([key[1]] * n, pa.int32()), pa.array(range(n), pa.int32()),
             pa.array(ids, pa.list_(pa.int64())), pa.array(list(vectors), pa.list_(pa.float64())),
             pa.array(edges, pa.list_(pa.int32())), pa.array([k == graph.entry for k in range(n)])],
            names=["dim", "shard", "node", "ids", "vec", "edges", "entry"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vecs = None, [], []
        for key, (i, v) in _shard_rows(batches, 2):
            if key != now and now is not None:
                yield rows(now, ids, vecs)
                ids, vecs = [], []
            now = key
            ids += i
            vecs += v
        if now is not None:
            yield rows(now, ids, vecs)

    return run


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", neighbours: int = 5,
                shard_rows: int = 8192, degree: int = 24, beam: int = 48) -> VectorIndex:
    """Index every usable row of ``vectors`` for searches of up to ``neighbours`` nearest.

    Null ids, null and zero vectors and vectors with null or non-finite
    components take no part; of rows that share an id the smallest vector
    counts.  Equal vectors are one node with its ``neighbours + 1`` smallest
    ids: all that an answer with ties to smaller ids can hold.  Vectors of
    different lengths are never compared.  A shard has about ``shard_rows``
    distinct vectors, so a task's memory does not grow with the table.  An
    empty table gives an empty index; other columns are not read.
    """
    scratch, copies = Scratch(vectors.sparkSession, "vectors"), neighbours + 1
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    nodes = scratch.stage(
        _vectors(vectors, id_col, vec_col).withColumn("place", place).filter(F.col("place") <= copies)
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "distinct")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"),
                         "ids", "vec")
    index = scratch.stage(dealt.repartitionByRange(shards, "dim", "shard").sortWithinPartitions("dim", "shard")
                          .mapInArrow(_build(degree, beam), _INDEX), "index")
    scratch.drop("distinct")
    return VectorIndex(scratch, index, shards, copies)


def _answers(width: int, k: int, block: int = 256):
    """Rows of one (dim, shard, part): first the nodes of the shard, then queries; out come the k nearest of the shard."""

    def answer(graph: Graph, ids: list, vectors: np.ndarray, norms: np.ndarray, qid: list, qvec: list) -> pa.RecordBatch:
        q = _scaled(np.array(qvec, np.float64))
        met, _ = graph.beam(_unit(q), min(width, len(ids)))
        out = []
        for row, (i, nodes) in enumerate(zip(qid, met)):
            nodes = nodes[nodes >= 0]
            score = (vectors[nodes] * q[row]).sum(axis=1) / (norms[nodes] * np.sqrt((q[row] * q[row]).sum()))
            found = [(-s, v) for s, node in zip(score.tolist(), nodes.tolist()) for v in ids[node] if v != i]
            out += [(i, v, -s) for s, v in sorted(found)[:k]]
        cols = list(zip(*out)) if out else [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
            names=["query_id", "vec_id", "score"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, graph, ids, vecs, edges, entry = None, None, [], [], [], 0
        for key, (kinds, node, some, vec, edge, first) in _shard_rows(batches, 3):
            if key != now:
                now, graph, ids, vecs, edges = key, None, [], [], []
            for k, kind in enumerate(kinds):
                if kind == 0:
                    entry = len(ids) if first[k] else entry
                    ids.append(some[k])
                    vecs.append(vec[k])
                    edges.append(edge[k])
            mine = [k for k, kind in enumerate(kinds) if kind == 1]
            if mine and ids:
                if graph is None:                # nodes come before the queries
                    vectors = _scaled(np.array(vecs, np.float64))
                    norms = np.sqrt((vectors * vectors).sum(axis=1))
                    flat = np.full((len(ids), max(1, max(map(len, edges)))), -1, np.int64)
                    for n, e in enumerate(edges):
                        flat[n, :len(e)] = e
                    graph, vecs, edges = Graph(_unit(vectors), flat, entry), [], []
                for lo in range(0, len(mine), block):
                    part = mine[lo:lo + block]
                    yield answer(graph, ids, vectors, norms, [some[k][0] for k in part], [vec[k] for k in part])

    return run


def search(index: VectorIndex, queries: DataFrame, k: int = 5, beam: int = 160, id_col: str = "vec_id",
           vec_col: str = "embedding", task_queries: int = 50_000) -> DataFrame:
    """The ``k`` nearest indexed rows found for each usable query: query_id, rank (from 1), vec_id, score.

    Score is the cosine in double precision; ties go to the smaller id, and a
    query's own id is never its answer.  Queries with fewer candidates get
    all of them.  Every shard sees every query, at most ``task_queries`` a
    task.
    """
    if k >= index.copies:
        raise ValueError(f"the index was built for up to {index.copies - 1} neighbours")
    asked = index.scratch.stage(_vectors(queries, id_col, vec_col), "queries")
    parts = max(1, -(-asked.count() // task_queries))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    nodes = index.nodes.select("dim", "shard", every.alias("part"), F.lit(0).alias("kind"), "node", "ids", "vec",
                               "edges", "entry")
    sent = asked.select(
        F.size("vec").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast("int").alias("node"), F.array("id").alias("ids"), "vec",
        F.lit(None).cast("array<int>").alias("edges"), F.lit(None).cast("boolean").alias("entry"))
    order = ["dim", "shard", "part", "kind", "node"]
    found = (nodes.union(sent).repartitionByRange(index.shards * parts, "dim", "shard", "part").sortWithinPartitions(*order)
             .mapInArrow(_answers(beam, k), "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
