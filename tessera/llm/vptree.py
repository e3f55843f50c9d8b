"""Nearest neighbours by cosine with a vantage-point tree per shard.

Vectors of length one have a chord distance that falls as their cosine
rises, and it obeys the triangle inequality.  Vectors go to the nearest of at
most ``PIVOTS`` pivots, and a pivot's vectors form shards of about
``SHARD_ROWS``; each task builds the tree of one shard and answers a block of
queries.  A query first visits its own pivot, whose k-th neighbour bounds the
search; then the pivots that the triangle inequality leaves.  Inside a tree a
child is visited while ``factor`` times its lower bound is at most the
query's bound: factor 1 is exact search, larger ones visit less.

Scores are the cosine in double precision, summed in the order of the
components, so equal vectors get equal scores.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part; a query has all candidates if there are fewer than
k; vectors of another dimension than the query's are no candidates; rows that
share an id are told apart by nothing and are each a candidate of other ids;
other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

PIVOTS = 1024
SHARD_ROWS = 2000
QUERY_BLOCK = 2000
LEAF = 64
_SLACK = 1e-7          # more than rounding takes from a distance


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines, each summed component by component."""
    dot = np.zeros((len(q), len(x)))
    nq, nx = np.zeros(len(q)), np.zeros(len(x))
    for j in range(q.shape[1]):
        dot += q[:, j, None] * x[None, :, j]
        nq += q[:, j] * q[:, j]
        nx += x[:, j] * x[:, j]
    return np.clip(dot / np.sqrt(nq[:, None] * nx[None, :]), -1.0, 1.0)


def chord(score: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * score, 0.0))


class VpTree:
    """Tree over the rows of ``x`` (ids ``ids``); answers many queries at once."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, factor: float):
        self.x, self.ids, self.factor = x, ids, factor
        self.unit = x / np.linalg.norm(x, axis=1)[:, None]
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        d = np.sqrt(np.maximum(2 - 2 * self.unit[rows] @ self.unit[rows[0]], 0))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = rows[order[:half]], rows[order[half:]]
        return (rows[0], d[order[half - 1]], d[order[half]], self._build(near), self._build(far))

    def search(self, q: np.ndarray, own: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), k columns, best first (-inf: none), for queries
        with ids ``own``, within the chord distance ``bound``."""
        self.q, self.own, self.bound = q, own, bound.copy()
        self.qu = q / np.linalg.norm(q, axis=1)[:, None]
        self.best = np.full((len(q), k), -np.inf)
        self.who = np.full((len(q), k), np.iinfo(np.int64).max)
        self._visit(self.root, np.arange(len(q)))
        return self.best, self.who

    def _visit(self, node, at: np.ndarray) -> None:
        if not len(at):
            return
        if not isinstance(node, tuple):
            s = exact_scores(self.q[at], self.x[node])
            ids = np.broadcast_to(self.ids[node], s.shape)
            s = np.where(ids == self.own[at][:, None], -np.inf, s)
            s = np.concatenate([self.best[at], s], axis=1)
            ids = np.where(s == -np.inf, np.iinfo(np.int64).max, np.concatenate([self.who[at], ids], axis=1))
            order = np.lexsort((ids, -s), axis=-1)[:, :self.best.shape[1]]
            self.best[at], self.who[at] = np.take_along_axis(s, order, 1), np.take_along_axis(ids, order, 1)
            full = self.best[at, -1] > -np.inf
            self.bound[at[full]] = np.minimum(self.bound[at[full]], chord(self.best[at[full], -1]))
            return
        v, inner, outer, near, far = node
        d = np.sqrt(np.maximum(2 - 2 * self.qu[at] @ self.unit[v], 0))
        first = d <= (inner + outer) / 2
        self._visit(near, at[first])
        self._visit(far, at[~first])
        low = np.where(first, outer - d, d - inner)     # to the other child
        go = low * self.factor <= self.bound[at] + _SLACK
        self._visit(far, at[go & first])
        self._visit(near, at[go & ~first])


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 5, factor: float = 1.0, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest other ids of each row
    with ``is_query`` (a condition on the columns ``id`` and ``v``)."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    all_rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"),
                              F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double")).alias("v"))
    all_rows = all_rows.where(F.col("id").isNotNull() & _usable(F.col("v"))).withColumn("dim", F.size("v"))
    total = all_rows.count()
    count = int(min(PIVOTS, max(1, -(-total // SHARD_ROWS))))
    # a bounded sample of pivots, by hash of the id
    some = all_rows.orderBy(F.xxhash64("id"), "id").limit(count).select("dim", "v").collect()
    pivots: dict[int, list] = {}
    for r in some:
        pivots.setdefault(r.dim, []).append(r.v)
    shared = vectors.sparkSession.sparkContext.broadcast(
        {d: (lambda p: p / np.linalg.norm(p, axis=1)[:, None])(np.array(p)) for d, p in pivots.items()})

    def distances(v):
        """For each vector the chord distances to the pivots of its dimension."""
        for x in v:
            u = np.array(x)
            p = shared.value.get(len(u))
            yield np.sqrt(np.maximum(2 - 2 * p @ (u / np.linalg.norm(u)), 0)) if p is not None else np.zeros(1)

    def assign(batches):
        for b in batches:
            d = list(distances(b.column(2).to_pylist()))
            at = [int(x.argmin()) for x in d]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32()),
                                              pa.array([float(x[i]) for x, i in zip(d, at)], pa.float64())],
                                             ["id", "dim", "v", "pivot", "gap"])
    placed = stage_table(all_rows.select("id", "dim", "v").mapInArrow(
        assign, "id long, dim int, v array<double>, pivot int, gap double"), "placed")
    size = placed.groupBy("dim", "pivot").agg(F.count("*").alias("_n"), F.max("gap").alias("radius")).withColumn(
        "parts", F.ceil(F.col("_n") / SHARD_ROWS).cast("int")).drop("_n")
    size = stage_table(size, "shards")                # PIVOTS rows a dimension
    radius = {(r.dim, r.pivot): r.radius for r in size.collect()}
    placed = placed.join(F.broadcast(size), ["dim", "pivot"]).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")).cast("int"))
    queries = placed.where(is_query).select("id", "dim", "v", F.col("pivot").alias("home"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(blocks)).cast("int"))

    def run(key, q, x):
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        tree = VpTree(np.stack(x["x_v"].to_numpy()).astype(float), x["x_id"].to_numpy(np.int64), factor)
        best, who = tree.search(np.stack(q["v"].to_numpy()).astype(float), q["id"].to_numpy(np.int64), k,
                                q["bound"].to_numpy(float))
        found = best > -np.inf
        return pd.DataFrame({"query_id": np.repeat(q["id"].to_numpy(np.int64), found.sum(axis=1)),
                             "vec_id": who[found], "score": best[found]})

    def ask(visits):
        """``visits``: id, dim, v, block, pivot, bound."""
        q = visits.join(F.broadcast(size), ["dim", "pivot"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "dim", "pivot", "part", "block", "id", "v", "bound")
        x = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            *[F.col(c).alias("x_" + c) for c in ("dim", "pivot", "part", "block", "id", "v")])
        key = ["dim", "pivot", "part", "block"]
        return q.groupBy(*key).cogroup(x.groupBy(*["x_" + c for c in key])).applyInPandas(
            run, "query_id long, vec_id long, score double")

    first = stage_table(ask(queries.withColumn("pivot", F.col("home")).withColumn(
        "bound", F.lit(float("inf")))), "first")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = first.withColumn("_r", F.row_number().over(order)).where(F.col("_r") == k).select(
        F.col("query_id").alias("id"), F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0))).alias("bound"))
    rest = queries.join(kth, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def more(batches):
        for b in batches:
            rows, to = [], []
            vs, homes, bounds = (b.column(i).to_pylist() for i in (2, 3, 5))
            for i, d in enumerate(distances(vs)):
                low = d - np.array([radius.get((len(vs[i]), p), -np.inf) for p in range(len(d))])
                go = (low * factor <= bounds[i] + _SLACK) & (np.arange(len(d)) != homes[i])
                rows += [i] * int(go.sum())
                to += np.flatnonzero(go).tolist()
            out = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), out.column(2), out.column(4),
                                              pa.array(to, pa.int32()), out.column(5)],
                                             ["id", "dim", "v", "block", "pivot", "bound"])
    visits = rest.select("id", "dim", "v", "home", "block", "bound").mapInArrow(
        more, "id long, dim int, v array<double>, block int, pivot int, bound double")
    both = first.unionByName(ask(visits))
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id").cast(kind), F.col("rank").cast("int"), F.col("vec_id").cast(kind), "score")
