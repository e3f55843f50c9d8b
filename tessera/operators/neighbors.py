"""Exact nearest-neighbour joins without enumerating all pairs
(SURVEY 2.3 J16-J18, 2.9 X12-X16, K9, F41).

Candidates come from a grid over at most three *orthonormal projections* of
the points (plain coordinates for geo / 3-D data, principal axes or leading
coordinates for embeddings).  A projection never lengthens a distance, so a
reference point outside the (2r+1)^d block of cells around a query is
farther than r*h from it.  A query is therefore final once its k-th candidate
lies within r*h; queries that are not final are retried on a grid twice as
coarse, until none is open.  Every round is one equi-join on cell keys plus a per-query top-k
(Spark plans the ``row_number() <= k`` filter as a partial group limit
before the shuffle).  The result is exact; no candidate cap is applied.
Cost follows local density: a cell holding a large share of the reference
points makes its neighbourhood's candidate lists long, which is where a
finer ``cell`` (or a blocking key in ``by``) should be given.
"""
from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_rows


#: Candidates that a task ranks in one round, about.
TASK_CANDIDATES = 2_000_000


def euclid(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(reduce(lambda x, y: x + y, [(x - y) * (x - y) for x, y in zip(a, b)]))


def vector_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equal-length numeric arrays."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def _offsets(d: int) -> list[tuple[int, ...]]:
    return list(itertools.product((-1, 0, 1), repeat=d))


def knn(query: DataFrame, ref: DataFrame, qid: str, rid: str, grid: Sequence[str], k: int,
        dist, by: Sequence[str] = (), cell: float | None = None, exclude_self: bool = False) -> DataFrame:
    """k nearest ``ref`` rows of every ``query`` row, exactly.

    ``grid``: up to 3 column names (present in both frames) holding an
    orthonormal projection of the points.  ``dist(q, r)``: Column giving the
    true distance from struct ``q`` (query row) to struct ``r`` (ref row);
    it must be >= the Euclidean distance of the ``grid`` columns.  ``by``:
    optional exact blocking keys (neighbours only within equal keys).
    Returns (qid, rid, distance, rank) with rank 1..k (ties by ``rid``).
    """
    by = list(by)
    d = len(grid)
    assert 1 <= d <= 3
    # one pass: extent of references (cell size) and of queries + references
    # (once a cell is wider than the joint extent, the 3^d block around any
    # query holds every reference point, so that round is final)
    both = query.select(*grid, F.lit(0).alias("_isref")).unionByName(ref.select(*grid, F.lit(1).alias("_isref")))
    isref = F.col("_isref") == 1
    st = both.agg(*[F.min(F.when(isref, F.col(g))).alias(f"lo{i}") for i, g in enumerate(grid)],
                  *[F.max(F.when(isref, F.col(g))).alias(f"hi{i}") for i, g in enumerate(grid)],
                  *[(F.max(g) - F.min(g)).alias(f"e{i}") for i, g in enumerate(grid)],
                  F.sum("_isref").alias("n"), F.sum(1 - F.col("_isref")).alias("asks")).first()
    span = max([st[f"e{i}"] or 0.0 for i in range(d)]) + 1e-9
    if cell is None:
        # about 4k reference points per cell: the 3^d block then nearly always
        # holds k points within one cell width, so most queries finish in round one
        vol = 1.0
        for i in range(d):
            vol *= max((st[f"hi{i}"] or 0.0) - (st[f"lo{i}"] or 0.0), 1e-9)
        cell = (vol * 4 * max(k, 1) / max(st["n"] or 1, 1)) ** (1.0 / d)
        # dense regions: if the densest cell at this width holds many more points than
        # needed, start finer (at most 64x) so its queries resolve from short candidate
        # lists; sparser queries reach their width in a few doubling rounds
        cells = [F.floor(F.col(g) / cell).cast("long") for g in grid]
        densest = ref.groupBy(*[c.alias(f"_d{i}") for i, c in enumerate(cells)], *by).count() \
            .agg(F.max("count")).first()[0] or 0
        target = 64 * max(k, 1)
        if densest > target:
            cell = cell / min((densest / target) ** (1.0 / d), 64.0)
    # queries are dealt so that a task ranks about TASK_CANDIDATES, however few files they come from
    deal = max(1, -(-(st["asks"] or 0) * 3 ** d * 4 * max(k, 1) // TASK_CANDIDATES))
    q = query.repartition(deal, qid).select(F.col(qid).alias("_qid"), *[F.col(b).alias(f"_b_{b}") for b in by],
                     F.struct(*[F.col(c) for c in query.columns]).alias("_q"))
    r = ref.select(F.col(rid).alias("_rid"), *[F.col(b).alias(f"_b_{b}") for b in by],
                   F.struct(*[F.col(c) for c in ref.columns]).alias("_r"))
    offs = F.array(*[F.array(*[F.lit(o) for o in off]) for off in _offsets(d)])
    done = []
    pending = q
    h = cell
    while True:
        rc = r.select("*", *[F.floor(F.col("_r").getField(g) / h).cast("long").alias(f"_c{i}")
                             for i, g in enumerate(grid)])
        qc = pending.select("*", F.explode(offs).alias("_off"))
        qc = qc.select("*", *[(F.floor(F.col("_q").getField(g) / h).cast("long") + F.col("_off")[i]).alias(f"_c{i}")
                              for i, g in enumerate(grid)]).drop("_off")
        keys = [f"_c{i}" for i in range(d)] + [f"_b_{b}" for b in by]
        cand = qc.join(rc, keys)
        if exclude_self:
            cand = cand.where(F.col("_qid") != F.col("_rid"))
        cand = cand.select("_qid", "_rid", dist(F.col("_q"), F.col("_r")).alias("distance"))
        w = Window.partitionBy("_qid").orderBy("distance", "_rid")
        # the round's lists serve the test and the result: joined and ranked once, then k rows per query
        top = stage_rows(cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "knn")
        if h >= span:
            done.append(top)                     # grid coarser than the data: every point was a candidate
            break
        stat = top.groupBy("_qid").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_dk"))
        ok_ids = stat.where((F.col("_n") >= k) & (F.col("_dk") <= h)).select("_qid")
        rest = stage_rows(pending.join(ok_ids, "_qid", "left_anti"), "knn-open")
        if rest.limit(1).count() == 0:
            done.append(top)
            break
        done.append(top.join(ok_ids, "_qid", "left_semi"))
        pending = rest
        h *= 2.0
    res = reduce(lambda a, b: a.unionByName(b), done)
    return res.select(F.col("_qid").alias(qid), F.col("_rid").alias(rid), "distance", "rank")


def nearest(query: DataFrame, ref: DataFrame, qid: str, rid: str, grid: Sequence[str], **kw) -> DataFrame:
    """Nearest reference row per query (F41 nearest place, J16 nearest point)."""
    return knn(query, ref, qid, rid, grid, 1,
               lambda a, b: euclid([a.getField(g) for g in grid], [b.getField(g) for g in grid]), **kw)


# ---------------------------------------------------------------- kNN imputation / classification
def knn_impute(df: DataFrame, id_col: str, target: str, features: Sequence[str], k: int,
               how: str = "mean", by: Sequence[str] = (), grid: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of ``target`` from the k nearest rows where it is present
    (X12 uniform mean, X13 distance-weighted, X14 within ``by`` partitions,
    X15 ``how='mode'`` for categories, X16 ``how='median'``).  Distance is
    Euclidean over ``features``; the grid uses up to three of them (or
    ``grid``).  Returns (id, imputed) for every row without a target; the
    value is null where a feature of the row is null or no row has a target."""
    feats = list(features)
    g = list(grid or feats[:3])
    whole = reduce(lambda x, y: x & y, [F.col(f).isNotNull() for f in feats])
    known = df.where(F.col(target).isNotNull() & whole)
    every = df.where(F.col(target).isNull())
    miss = every.where(whole)
    nb = _knn_same_id(miss, known, id_col, g, k, feats, by)
    vals = known.select(F.col(id_col).alias("_nb"), F.col(target).alias("_v"))
    j = nb.join(vals, "_nb")
    if how == "mean":
        e = F.avg("_v")
    elif how == "distance":
        wgt = 1 / F.greatest(F.col("distance"), F.lit(1e-12))
        e = F.sum(wgt * F.col("_v")) / F.sum(wgt)
    elif how == "median":
        e = F.median("_v")
    elif how == "mode":
        e = F.mode("_v", deterministic=True)
    else:
        raise ValueError(how)
    return every.select(id_col).join(j.groupBy(id_col).agg(e.alias("imputed")), id_col, "left")


def _knn_same_id(miss, known, id_col, grid, k, feats, by):
    r = known.withColumnRenamed(id_col, "_nb")
    return knn(miss, r, id_col, "_nb", grid, k,
               lambda a, b: euclid([a.getField(f) for f in feats], [b.getField(f) for f in feats]), by=by)
