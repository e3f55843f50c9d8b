"""Exact nearest neighbours of vectors of any length, also with nulls.

References are dealt to the nearest of ``pivots`` reference points; each
keeps its distance to that pivot (its ring).  A query first meets the members
of its own pivot's cell, which bounds the distance of its k-th neighbour.
By the triangle inequality a member with ring r of a cell whose pivot is at
distance d cannot be nearer than |d - r|, so in the second round the query
visits only cells, and in them only rings, within that bound.  Nothing is
approximate and no list is capped.

Scale: the pivots are a bounded broadcast.  Cells are dealt in parts of about
``PART`` members, and the queries that visit a cell in parts of about
``VISITS``, so that no task holds more than one part of each, whatever share
of the rows one cell has.  A query travels to the cells it visits, a member
once per part of visitors.

Nulls: ``nan_knn`` turns the nan-Euclidean distance into plain ones.  It is
Euclidean over the coordinates that both rows have, scaled by all over
shared coordinates, so for a given pair of null patterns it is a metric on
the shared coordinates: queries and references are taken once per pattern of
the other side, with the others' coordinates at zero and the scale applied,
and are searched per pair of patterns.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PART = 4_000
VISITS = 8_000
#: Queries that meet a part's members in one matrix product.
BLOCK = 256
MAX_PATTERNS = 4_096


def array_of(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, without the
    cancellation of the expanded square."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, len(a), 256):
        out[i:i + 256] = np.sqrt(((a[i:i + 256, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _near(a: pd.DataFrame, b: pd.DataFrame, k: int, exclude_self: bool) -> list[pd.DataFrame]:
    """The k nearest members (r, v, ring) of each query (q, g, v, ring, bound)
    within its bound, for blocks of queries at once: the expanded square by one
    matrix product leaves out the members that its rounding cannot bring into
    the k nearest; the rest is measured directly."""
    b, a = b.sort_values("ring", kind="stable"), a.sort_values("ring", kind="stable")
    m, ring, ids = _matrix(b["v"]), b["ring"].to_numpy(float), b["r"].to_numpy()
    v, away, bound = _matrix(a["v"]), a["ring"].to_numpy(float), a["bound"].to_numpy(float)
    asks, groups = a["q"].to_numpy(), a["g"].to_numpy()
    # products of vectors near the members' mean keep more digits
    mid = m.mean(axis=0)
    mid = np.where(np.isfinite(mid), mid, 0.0)
    mc, vc = m - mid, v - mid
    mm, vv = (mc * mc).sum(axis=1), (vc * vc).sum(axis=1)
    first, last = np.searchsorted(ring, away - bound, "left"), np.searchsorted(ring, away + bound, "right")
    out = []
    for i in range(0, len(v), BLOCK):
        j = min(i + BLOCK, len(v))
        x, y = int(first[i:j].min()), int(last[i:j].max())
        if x >= y:
            continue
        near = vv[i:j, None] + mm[None, x:y] - 2.0 * (vc[i:j] @ mc[x:y].T)
        slack = 1e-12 * (m.shape[1] + 8) * (vv[i:j] + mm[x:y].max())
        if not np.isfinite(slack).all():                 # no estimate of an infinite component: measure all
            near[:] = 0.0
        at = np.arange(x, y)
        near[(at < first[i:j, None]) | (at >= last[i:j, None])] = np.inf
        if exclude_self:
            near[asks[i:j, None] == ids[None, x:y]] = np.inf
        cap = bound[i:j] ** 2 + slack
        if y - x > k:
            cap = np.minimum(cap, np.partition(near, k - 1, axis=1)[:, k - 1] + 2.0 * slack)
        row, col = np.nonzero((near <= cap[:, None]) & (near < np.inf))
        if not len(row):
            continue
        dist = np.concatenate([np.sqrt(((m[x + col[c:c + 65_536]] - v[i + row[c:c + 65_536]]) ** 2).sum(axis=1))
                               for c in range(0, len(row), 65_536)])
        keep = dist <= bound[i + row]
        row, col, dist = row[keep], col[keep], dist[keep]
        order = np.lexsort((ids[x + col], dist, row))
        row, col, dist = row[order], col[order], dist[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        row, col, dist = row[rank < k], col[rank < k], dist[rank < k]
        out.append(pd.DataFrame({"q": asks[i + row], "g": groups[i + row], "r": ids[x + col], "distance": dist}))
    return out


def _matrix(values) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in values]) if len(values) else np.zeros((0, 0))


def knn_vectors(query: DataFrame, ref: DataFrame, k: int, *, qid: str, rid: str, vector: str, by: Sequence[str] = (),
                pivots: int = 32, exclude_self: bool = False) -> DataFrame:
    """(by, qid, rid, distance, rank): the k nearest references of each query
    within equal ``by`` (ties by rid; fewer where there are fewer).  Both
    frames have ``vector`` (array of numbers of one length; rows with a null
    in it take no part) and ``by`` with equal names and types.  ``exclude_self``:
    a reference whose id equals the query's is left out."""
    by = list(by)
    group = F.xxhash64(*[F.col(f"`{b}`") for b in by]) if by else F.lit(0).cast("long")

    def clean(df: DataFrame, key: str, name: str) -> DataFrame:
        v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
        whole = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
        return df.select(F.col(f"`{key}`").alias(name), group.alias("g"), v.alias("v"),
                         F.struct(*[F.col(f"`{b}`") for b in by] or [F.lit(0).alias("_")]).alias("by")).where(whole)
    q, r = clean(query, qid, "q"), clean(ref, rid, "r")
    kq, kr = q.schema["q"].dataType.simpleString(), r.schema["r"].dataType.simpleString()
    chosen = r.orderBy(F.xxhash64("r", F.lit(1)), "r").limit(pivots).select("v").collect()
    if not chosen:                                       # no references, no neighbours
        return query.limit(0).select(*by, qid, F.lit(None).cast(kr).alias(rid), F.lit(0.0).alias("distance"),
                                     F.lit(1).alias("rank"))
    points = _matrix([x["v"] for x in chosen])

    def place(key: str):
        def run(frames):
            for f in frames:
                d = _distances(_matrix(f["v"]), points) if len(f) else np.zeros((0, len(points)))
                yield f.assign(cell=d.argmin(axis=1).astype(np.int32), ring=d.min(axis=1), away=list(d))[
                    [key, "g", "v", "cell", "ring", *(["away"] if key == "q" else [])]]
        return run
    r = r.select("r", "g", "v").mapInPandas(place("r"), f"r {kr}, g long, v array<double>, cell int, ring double")
    q1 = q.select("q", "g", "v").mapInPandas(place("q"), f"q {kq}, g long, v array<double>, cell int, ring double, "
                                                         "away array<double>")
    r, q1 = cut_lineage(r), cut_lineage(q1)
    cells = r.groupBy("g", "cell").agg(F.count("*").alias("n"), F.min("ring").alias("lo"), F.max("ring").alias("hi"))

    def search(visits: DataFrame) -> DataFrame:
        """Top k of every (query, part of a cell) among ``visits`` (q, g, cell,
        v, ring: distance to the cell's pivot, bound)."""
        asked = visits.groupBy("g", "cell").agg(F.ceil(F.count("*") / VISITS).cast("int").alias("shares"))
        shape = cells.join(asked, ["g", "cell"]).select("g", "cell", F.ceil(F.col("n") / PART).cast("int").alias("parts"),
                                                        "shares")
        left = (visits.join(shape, ["g", "cell"])
                .withColumn("share", F.pmod(F.xxhash64("q"), F.col("shares")).cast("int"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
        right = (r.join(shape, ["g", "cell"])
                 .withColumn("part", F.pmod(F.xxhash64("r"), F.col("parts")).cast("int"))
                 .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))))
        keys = ["g", "cell", "part", "share"]

        def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"q": [], "g": [], "r": [], "distance": []})
            out = _near(a, b, k, exclude_self)
            return pd.concat(out) if out else pd.DataFrame({"q": [], "g": [], "r": [], "distance": []})
        return left.select(*keys, "q", "v", "ring", "bound").groupBy(*keys).cogroup(
            right.select(*keys, "r", "v", "ring").groupBy(*keys)).applyInPandas(
            near, f"q {kq}, g long, r {kr}, distance double")

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("q", "g").orderBy("distance", "r")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    home = cut_lineage(best(search(q1.withColumn("bound", F.lit(float("inf"))))))
    # rounding: a bound that is wider by some last digits loses nothing
    limit = home.groupBy("q", "g").agg(F.count("*").alias("_n"), (F.max("distance") * (1 + 1e-9) + 1e-12).alias("_d"))
    open_ = q1.join(limit, ["q", "g"], "left").withColumn(
        "bound", F.when(F.col("_n") >= k, F.col("_d")).otherwise(F.lit(float("inf"))))
    rings = cells.groupBy("g").agg(F.collect_list(F.struct("cell", "lo", "hi")).alias("cells"))   # at most ``pivots``
    visits = (open_.join(rings, "g").select("q", "g", "v", "away", "bound", F.col("cell").alias("_home"),
                                            F.explode("cells").alias("c"))
              .withColumn("ring", F.col("away")[F.col("c.cell")])
              .where((F.col("c.cell") != F.col("_home")) & (F.col("ring") - F.col("bound") <= F.col("c.hi"))
                     & (F.col("ring") + F.col("bound") >= F.col("c.lo")))
              .select("q", "g", F.col("c.cell").alias("cell"), "v", "ring", "bound"))
    found = best(home.drop("rank").unionByName(search(visits)))
    names = q.select("q", "g", "by").distinct()
    return found.join(names, ["q", "g"]).select(*[F.col("by").getField(b).alias(b) for b in by], F.col("q").alias(qid),
                                                F.col("r").alias(rid), "distance", "rank")


# ---------------------------------------------------------------- nulls
def _pattern(vector: Column) -> Column:
    """Which coordinates are present, as text."""
    return F.array_join(F.transform(vector, lambda x: F.when(x.isNull() | F.isnan(x), "0").otherwise("1")), "")


def nan_knn(query: DataFrame, ref: DataFrame, k: int, *, qid: str, rid: str, vector: str, by: Sequence[str] = (),
            pivots: int = 32, exclude_self: bool = False) -> DataFrame:
    """``knn_vectors`` by nan-Euclidean distance: sqrt(all / shared * sum over
    shared coordinates); rows without a shared coordinate are no neighbours.
    The null patterns of each side are at most ``MAX_PATTERNS`` (ValueError)."""
    by = list(by)

    def patterned(df: DataFrame, key: str) -> DataFrame:
        v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
        return df.select(*by, key, v.alias("_v")).withColumn("_p", _pattern(F.col("_v")))
    q, r = patterned(query, qid), patterned(ref, rid)
    found = []
    for side in (q, r):
        got = [x["_p"] for x in side.select("_p").distinct().limit(MAX_PATTERNS + 1).collect()]
        if len(got) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} null patterns")
        found.append(sorted(got))

    def masked(df: DataFrame, own: str, other: str, others: list[str]) -> DataFrame:
        """Rows once per pattern of the other side, reduced to the shared coordinates."""
        each = df.withColumnRenamed("_p", own).withColumn(other, F.explode(F.array(*[F.lit(p) for p in others])))
        present = F.transform(F.col("_v"), lambda x, i: (F.substring(F.col(own), i + 1, F.lit(1)) == "1")
                              & (F.substring(F.col(other), i + 1, F.lit(1)) == "1"))
        each = each.withColumn("_both", present).withColumn("_n", F.size(F.filter("_both", lambda b: b)))
        scale = F.sqrt(F.size("_v") / F.col("_n"))
        vec = F.transform(F.col("_v"), lambda x, i: F.when(F.get("_both", i), x * scale).otherwise(0.0))
        return each.where("_n > 0").withColumn("_vec", vec).drop("_v", "_both", "_n")
    got = knn_vectors(masked(q, "_pq", "_pr", found[1]), masked(r, "_pr", "_pq", found[0]), k, qid=qid, rid=rid,
                      vector="_vec", by=[*by, "_pq", "_pr"], pivots=pivots, exclude_self=exclude_self)
    w = Window.partitionBy(*by, qid).orderBy("distance", rid)
    return (got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(*by, qid, rid, "distance", "rank"))


def nan_knn_impute(df: DataFrame, id_col: str, columns: Sequence[str], target: str, fills: dict[str, tuple[str, int]], *,
                   by: Sequence[str] = (), pivots: int = 32) -> DataFrame:
    """(id, one column per name in ``fills``) for the rows whose ``target`` is
    null.  ``fills`` maps a name to (how, k): from the k nearest rows that have
    the target, by nan-Euclidean distance over all ``columns``, their 'mean'
    (X12), 'distance'-weighted mean (X13), 'mode' (X15) or 'median' (X16);
    within equal ``by`` (X14).  A row without such a neighbour gets the
    column's mean (null for 'mode').  One search serves all fills."""
    vec = df.select(id_col, *by, F.col(target).alias("_t"), array_of(columns).alias("_x"))
    known, miss = vec.where("_t is not null"), vec.where("_t is null")
    nb = nan_knn(miss, known.withColumnRenamed(id_col, "_nb"), max(k for _, k in fills.values()), qid=id_col, rid="_nb",
                 vector="_x", by=by, pivots=pivots)
    j = nb.join(known.select(F.col(id_col).alias("_nb"), F.col("_t").alias("_value")), "_nb")

    def fill(how: str, k: int) -> Column:
        near = F.col("rank") <= k
        value, touch = F.when(near, F.col("_value")), near & (F.col("distance") == 0)
        weight = F.when(near, F.try_divide(F.lit(1.0), F.col("distance")))
        if how == "distance":                            # neighbours at no distance decide alone
            return F.coalesce(F.avg(F.when(touch, value)), F.try_divide(F.sum(weight * value), F.sum(weight)))
        return {"mean": F.avg, "median": F.median, "mode": lambda v: F.mode(v, deterministic=True)}[how](value)
    got = j.groupBy(id_col).agg(*[fill(*spec).alias(name) for name, spec in fills.items()])
    mean = known.select(F.avg("_t")).scalar() if any(how != "mode" for how, _ in fills.values()) else None
    return miss.select(id_col).join(got, id_col, "left").select(id_col, *[
        (F.col(name) if how == "mode" else F.coalesce(name, mean)).alias(name) for name, (how, _) in fills.items()])
