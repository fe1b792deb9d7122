"""Approximate nearest neighbours by cosine, over robust-pruned directed graphs.

Rows are dealt to shards of bounded size. Per shard a directed graph is grown in batches: a greedy
beam search in the graph so far proposes neighbours for each new node, and relaxed distance pruning
keeps diverse ones (a candidate goes if a kept one is ``alpha`` times nearer to it than the new node
is). Kept edges are also added backwards; nodes with too many are pruned anew. The index is a table
of its own, one row per vector, which later searches can read.

A search runs a beam over each shard's graph: queries stream through the task behind the shard's
rows, so a task holds one shard and one batch of queries, however many queries there are. Nodes
found are scored on the original vectors in double precision; Spark merges the shards' answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, thin_parts

#: Rows and bytes of a shard, edges of a node, and beams while building and searching.
SHARD_ROWS, SHARD_BYTES = 8192, 64 << 20
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 48, 128, 1.2
#: Nodes expanded at once for a query, entry points, queries or new nodes searched together.
EXPAND, ENTRIES, TOGETHER = 4, 8, 256
#: Unit vectors equal on this grid share a node: copies, scaled or not, would crowd a beam.
GRID = 2.0 ** 18
INDEX = "dim int, shard long, node int, vec_id long, vec binary, edges binary"


def _search(x: np.ndarray, edges: np.ndarray, q: np.ndarray, beam: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of the queries ``q`` in step, among the first ``n`` nodes: per query the nodes
    found (-1: none) and their distances (minus the cosine), nearest first."""
    entry = np.arange(min(ENTRIES, n, beam))
    b, width = len(q), edges.shape[1]
    seen = np.full((b, n), -1, np.int16)
    ids, dist, done = np.full((b, beam), -1, np.int32), np.full((b, beam), np.inf, np.float32), np.ones((b, beam), bool)
    start = -(q @ x[entry].T)
    order = np.argsort(start, axis=1, kind="stable")
    ids[:, :len(entry)], dist[:, :len(entry)] = entry[order], np.take_along_axis(start, order, 1)
    done[:, :len(entry)], seen[:, entry] = False, 0
    active = np.arange(b)
    while True:
        active = active[~done[active].all(axis=1)]
        if not len(active):
            return ids, dist
        here, rows = active[:, None], np.arange(len(active))[:, None]
        at = np.argsort(done[active], axis=1, kind="stable")[:, :EXPAND]
        nodes = np.where(done[here, at], -1, ids[here, at])
        done[here, at] = True
        found = np.where(nodes[:, :, None] < 0, -1, edges[nodes]).reshape(len(active), -1)
        row, col = np.nonzero(found >= 0)
        node, query = found[row, col], active[row]
        fresh = seen[query, node] < 0
        row, col, node, query = row[fresh], col[fresh], node[fresh], query[fresh]
        # of a node proposed twice in this step, the last place remains
        seen[query, node] = col
        once = seen[query, node] == col
        row, col, node, query = row[once], col[once], node[once], query[once]
        near = np.full((len(active), nodes.shape[1] * width), np.inf, np.float32)
        near[row, col] = -np.einsum("ij,ij->i", q[query], x[node])
        both = np.concatenate([dist[active], near], axis=1)
        best = np.argpartition(both, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(both[rows, best], axis=1, kind="stable"), 1)
        dist[active] = both[rows, best]
        ids[active] = np.where(np.isinf(dist[active]), -1, np.concatenate([ids[active], found], axis=1)[rows, best])
        done[active] = np.concatenate([done[active], np.zeros(found.shape, bool)], axis=1)[rows, best] | (ids[active] < 0)


def _prune(x: np.ndarray, cand: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) up to ``degree`` diverse ones."""
    away = np.where(cand >= 0, np.maximum(2 + 2 * dist, 0), np.inf)
    v = x[cand]
    between = np.maximum(2 - 2 * (v @ v.transpose(0, 2, 1)), 0)
    left, out, rows = cand >= 0, np.full((len(cand), degree), -1, np.int32), np.arange(len(cand))
    for k in range(degree):
        pick = left.argmax(axis=1)
        some = left[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        left &= alpha * alpha * between[rows, pick] > away
        left[rows, pick] = False
    return out


def grow_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> np.ndarray:
    """The edges (node by place, -1: none) of a graph over the unit vectors ``x``, in their order."""
    n = len(x)
    edges = np.full((n, degree), -1, np.int32)
    first = min(n, degree + 1)
    for i in range(first):
        edges[i, :first - 1] = np.delete(np.arange(first), i)
    at = first
    while at < n:
        new = np.arange(at, min(n, at + min(TOGETHER, max(16, at // 4))))
        cand, dist = _search(x, edges, x[new], beam, at)
        edges[new] = _prune(x, cand, dist, degree, alpha)
        row, col = np.nonzero(edges[new] >= 0)
        to, back = edges[new][row, col], new[row]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        nodes, begin, size = np.unique(to, return_index=True, return_counts=True)
        more = np.full((len(nodes), size.max()), -1, np.int32)
        more[np.repeat(np.arange(len(nodes)), size), np.arange(len(to)) - np.repeat(begin, size)] = back
        cand = np.concatenate([edges[nodes], more], axis=1)
        cand = np.take_along_axis(cand, np.argsort(cand < 0, axis=1, kind="stable"), 1)
        fits = (cand >= 0).sum(axis=1) <= degree
        edges[nodes[fits]] = cand[fits][:, :degree]
        nodes, cand = nodes[~fits], cand[~fits]
        if len(nodes):
            dist = np.where(cand >= 0, -np.einsum("bd,bcd->bc", x[nodes], x[cand]), np.inf)
            order = np.argsort(dist, axis=1, kind="stable")
            edges[nodes] = _prune(x, np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1), degree, alpha)
        at = new[-1] + 1
    return edges


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaling by a power of two first is exact and keeps squares finite."""
    v = v.astype(np.float64)
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _pack(kind: str):
    """(vec_id, vec list) to (vec_id, dim, vec binary), without rows that take no part."""
    dtype = np.dtype(kind)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, lists = batch.column(0), batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)  # null components become NaN
            size = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            row = np.repeat(np.arange(len(size)), size)
            bad = np.bincount(row, ~np.isfinite(values), len(size)) > 0
            some = np.bincount(row, values != 0, len(size)) > 0
            good = np.flatnonzero(some & ~bad & ids.is_valid().to_numpy(zero_copy_only=False))
            data = [values[ends[i] - size[i]:ends[i]].tobytes() for i in good]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(good, pa.int64())), pa.array(size[good], pa.int32()), pa.array(data, pa.binary())],
                                             names=["vec_id", "dim", "vec"])

    return run


def packed_vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(vec_id, dim, vec) of the rows that take part, and the number type of ``vec``."""
    single = isinstance(df.schema[vec_col].dataType.elementType, T.FloatType)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    kind = "<f4" if single else "<f8"
    return rows.mapInArrow(_pack(kind), "vec_id long, dim int, vec binary"), kind


def _runs(it: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[bool, pa.Table]]:
    """Rows sorted by dim and shard as (whether a new shard begins, table of one shard), at most
    ``rows`` at once."""
    last = None
    for batch in it:
        dims, shards = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("dim", "shard"))
        cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(dims)]):
            if b > a:
                key = (dims[a], shards[a])
                for i in range(a, b, rows):
                    yield key != last, pa.Table.from_batches([batch.slice(i, min(rows, b - i))])
                    last = key


def _vectors(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _build(kind: str, degree: int, beam: int, alpha: float):
    def graph(parts: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(parts)
        ids, v = table["vec_id"].to_numpy(), _vectors(table["vec"], kind)
        unit = _unit(v)
        _, node = np.unique(np.round(unit * GRID).astype(np.int32), axis=0, return_inverse=True)
        # nodes in an order of no meaning, so that every part of the graph is a sample
        node = np.random.default_rng(len(ids)).permutation(node.max() + 1)[node.reshape(-1)]
        order = np.lexsort((ids, node))
        first = np.flatnonzero(np.diff(node[order], prepend=-1))
        edges = grow_graph(unit[order[first]].astype(np.float32), degree, beam, alpha)
        packed = np.full(len(ids), None, object)
        packed[first] = [e[e >= 0].tobytes() for e in edges]
        table = table.take(pa.array(order)).append_column("node", pa.array(node[order], pa.int32())).append_column("edges", pa.array(packed, pa.binary()))
        return table.select(["dim", "shard", "node", "vec_id", "vec", "edges"]).combine_chunks().to_batches()[0]

    def run(it):
        parts: list[pa.Table] = []
        for new, table in _runs(it, SHARD_ROWS):
            if new and parts:
                yield graph(parts)
                parts = []
            parts.append(table)
        if parts:
            yield graph(parts)

    return run


def build_index(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS,
                degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[DataFrame, str]:
    """The written index (``INDEX``; ``edges`` on the first row of a node) and the number type of its
    vectors. Rows are dealt to shards at random, copies too, so no vector makes a shard grow."""
    spark = df.sparkSession
    vectors, kind = packed_vectors(df, id_col, vec_col)
    rows, size = vectors.agg(F.count("*"), F.sum(F.octet_length("vec"))).first()
    shards = max(1, -(-rows // shard_rows), -(-(size or 0) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards))
    dealt = vectors.withColumn("shard", shard).repartition(thin_parts(spark, shards), "dim", "shard").sortWithinPartitions("dim", "shard", "vec_id", "vec")
    return materialize(dealt.mapInArrow(_build(kind, degree, beam, alpha), INDEX)), kind


def _answers(kind: str, k: int, beam: int):
    class Shard:
        def __init__(self, parts: list[pa.Table]):
            table = pa.concat_tables(parts)
            self.ids, node = table["vec_id"].to_numpy(), table["node"].to_numpy()
            self.unit = _unit(_vectors(table["vec"], kind))
            self.start = np.append(np.flatnonzero(np.diff(node, prepend=-1)), len(node))
            self.x = self.unit[self.start[:-1]].astype(np.float32)
            edges = [np.frombuffer(e, np.int32) for e in table["edges"].to_pylist() if e is not None]
            self.edges = np.full((len(edges), max(1, *(len(e) for e in edges), 1)), -1, np.int32)
            for i, e in enumerate(edges):
                self.edges[i, :len(e)] = e

        def answer(self, table: pa.Table) -> Iterator[tuple[int, int, float]]:
            own, q = table["vec_id"].to_numpy(), _unit(_vectors(table["vec"], kind))
            found, _ = _search(self.x, self.edges, q.astype(np.float32), beam, len(self.x))
            for i in range(len(own)):
                # more nodes than asked for, since single precision may swap near ones
                nodes = found[i][found[i] >= 0][:2 * k + 8]
                rows = np.concatenate([np.arange(self.start[j], self.start[j + 1]) for j in nodes])
                rows = rows[self.ids[rows] != own[i]]
                score = (self.unit[rows] * q[i]).sum(axis=1)
                order = np.lexsort((self.ids[rows], -score))
                taken: dict[int, float] = {}
                for j in order:
                    taken.setdefault(int(self.ids[rows[j]]), float(score[j]))
                    if len(taken) == k:
                        break
                yield from ((int(own[i]), vec_id, s) for vec_id, s in taken.items())

    def run(it):
        parts: list[pa.Table] = []
        shard = None
        for new, table in _runs(it, TOGETHER):
            if new:
                parts, shard = [], None
            asked = pa.compute.is_null(table["node"])
            rows = table.filter(pa.compute.invert(asked))
            if len(rows):
                parts.append(rows)
            rows = table.filter(asked)
            if len(rows) and parts:
                shard = shard or Shard(parts)
                out = list(zip(*shard.answer(rows)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                                                     names=["query_id", "vec_id", "score"])

    return run


def search_index(index: DataFrame, kind: str, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 k: int = 5, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each query, by cosine, ties to
    the smaller id. Rows with the query's own id are no answers; an id of several rows is one answer,
    with its nearest row. Of queries of one id the one of smallest vector is asked. Vectors of
    another length than the query's are no candidates."""
    spark = index.sparkSession
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    one = F.min_by("vec", F.struct("dim", "vec")).alias("vec"), F.min("dim").alias("dim")
    asked = packed_vectors(queries.withColumn(vec_col, F.col(vec_col).cast("array<float>" if kind == "<f4" else "array<double>")), id_col, vec_col)[0]
    asked = asked.groupBy("vec_id").agg(*one)
    asked = asked.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                         F.lit(None).cast("int").alias("node"), "vec_id", "vec", F.lit(None).cast("binary").alias("edges"))
    rows = index.unionByName(asked).repartition(thin_parts(spark, shards), "dim", "shard").sortWithinPartitions("dim", "shard", F.col("node").asc_nulls_last(), "vec_id")
    found = rows.mapInArrow(_answers(kind, k, beam), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth pair of rows asks (ids divisible by 50); null, zero and non-finite vectors and
    null ids neither ask nor answer; no rows give no rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index, kind = build_index(vectors)
    return search_index(index, kind, vectors.filter(F.col("vec_id") % 50 == 0))
