"""Geo and nearest-neighbour queries (SURVEY 2.8 F36-F41, 2.3 J16-J18,
2.9 X12-X16, K9).  The oracles are brute-force all-pairs SQL, which the
exact grid method must reproduce.

Coordinates: customers and suppliers get deterministic latitude /
longitude from a seeded hash of their key (inside a California-sized box);
3-D points are the first three embedding components.
"""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import neighbors as N
from ..operators import vectors as VN
from ..operators.ordering import uniform
from .registry import register
from .relational import SQL_UNIFORM


def _latlon(df, key, s1, s2):
    return df.select(key, (32.5 + 9.5 * uniform(key, s1)).alias("lat"), (-124.3 + 10 * uniform(key, s2)).alias("lon"))


def _latlon_sql(key, s1, s2):
    return f"32.5 + 9.5 * {SQL_UNIFORM(key, s1)} AS lat, -124.3 + 10 * {SQL_UNIFORM(key, s2)} AS lon"


def _hav_sql(lat2, lon2):
    p1, p2, l1, l2 = "radians(lat)", f"radians({lat2})", "radians(lon)", f"radians({lon2})"
    h = f"(pow(sin(({p2} - {p1}) / 2), 2) + cos({p1}) * cos({p2}) * pow(sin(({l2} - {l1}) / 2), 2))"
    return f"(2 * {G.EARTH_RADIUS_KM} * asin(sqrt({h})) * {G.FT_PER_KM})"


def _seg_sql(a, b):
    ax, ay = a
    bx, by = b
    dx, dy = bx - ax, by - ay
    L2 = dx * dx + dy * dy
    t = f"least(greatest(((lat - {ax}) * {dx} + (lon - {ay}) * {dy}) / {L2}, 0.0), 1.0)"
    qx, qy = f"({ax} + {t} * {dx})", f"({ay} + {t} * {dy})"
    return f"sqrt((lat - {qx}) * (lat - {qx}) + (lon - {qy}) * (lon - {qy}))"


def _rot_sql(deg):
    a = math.radians(deg)
    return (f"{math.cos(a)} * lon + {math.sin(a)} * lat", f"{math.cos(a)} * lat + {math.sin(a)} * lon")


_M = math.exp(math.log(1e6) / 20)


@register("g36_geo_features", "F36 F37 F38 F39 J16",
          "c_custkey:i rot15_x:f rot15_y:f rot30_x:f rot30_y:f rot45_x:f rot45_y:f dist_SC:f dist_SF:f dist_SJ:f "
          "dist_LA:f dist_SD:f dist_nearest_city:f dist_to_coast:f exp_latlon1:f exp_latlon2:f", sql=f"""
WITH c AS (SELECT c_custkey, {_latlon_sql('c_custkey', 21, 22)} FROM customer)
SELECT c_custkey, {', '.join(f"{_rot_sql(d)[0]} AS rot{d}_x, {_rot_sql(d)[1]} AS rot{d}_y" for d in (15, 30, 45))},
  {', '.join(f"{_hav_sql(v[0], v[1])} AS dist_{k}" for k, v in G.CITIES.items())},
  least({', '.join(_hav_sql(v[0], v[1]) for v in G.CITIES.values())}) AS dist_nearest_city,
  least({', '.join(_seg_sql(G.COAST[i], G.COAST[i + 1]) for i in range(len(G.COAST) - 1))}) AS dist_to_coast,
  cos(lat * 1.0) AS exp_latlon1, sin(lat * {_M}) AS exp_latlon2
FROM c""")
def g36_geo_features(t):
    c = _latlon(t.customer, "c_custkey", 21, 22)
    rots = []
    for d in (15, 30, 45):
        x, y = G.rotate("lat", "lon", d)
        rots += [x.alias(f"rot{d}_x"), y.alias(f"rot{d}_y")]
    enc = G.angular_encoding("lat", "lon")
    return c.select("c_custkey", *rots, *[v.alias(k) for k, v in G.city_distances("lat", "lon").items()],
                    G.polyline_distance("lat", "lon").alias("dist_to_coast"),
                    enc[0].alias("exp_latlon1"), enc[1].alias("exp_latlon2"))


_SLOTS = [f"{v}{i}" for v in ("lat", "lon") for i in range(20)]


@register("f39_angular_slots", "F39", "c_custkey:i " + " ".join(f"{c}:f" for c in _SLOTS), sql=f"""
WITH c AS (SELECT c_custkey, {_latlon_sql('c_custkey', 21, 22)} FROM customer)
SELECT c_custkey, {', '.join(f"{'sin' if i % 2 else 'cos'}({v} * {_M ** i!r}) AS {v}{i}" for v in ("lat", "lon") for i in range(20))}
FROM c""")
def f39_angular_slots(t):
    enc = G.angular_encoding("lat", "lon")
    return _latlon(t.customer, "c_custkey", 21, 22).select("c_custkey", *[enc[i].alias(c) for i, c in enumerate(_SLOTS)])


_REGIONS = range(5)


@register("f40_centre_distances", "F40", "c_custkey:i " + " ".join(f"cluster_{i}:f" for i in _REGIONS), sql=f"""
WITH c AS (SELECT c_custkey, n_regionkey, {_latlon_sql('c_custkey', 21, 22)}
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
{', '.join(f"m{i} AS (SELECT avg(lat) AS la{i}, avg(lon) AS lo{i} FROM c WHERE n_regionkey = {i})" for i in _REGIONS)}
SELECT c_custkey, {', '.join(f"{_hav_sql(f'la{i}', f'lo{i}')} AS cluster_{i}" for i in _REGIONS)}
FROM c, {', '.join(f"m{i}" for i in _REGIONS)}""")
def f40_centre_distances(t):
    """Distance of each customer to the mean place of each region's customers."""
    c = t.customer.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
    c = c.select("c_custkey", "n_regionkey", (32.5 + 9.5 * uniform("c_custkey", 21)).alias("lat"),
                 (-124.3 + 10 * uniform("c_custkey", 22)).alias("lon"))
    centres = {r["n_regionkey"]: (r["lat"], r["lon"]) for r in c.groupBy("n_regionkey").agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).collect()}          # five regions
    far = G.centre_distances("lat", "lon", [centres[i] for i in _REGIONS])
    return c.select("c_custkey", *[v.alias(k) for k, v in far.items()])


@register("f41_nearest_place", "F41 J16 J18", "c_custkey:i s_suppkey:i distance:f", sql=f"""
WITH c AS (SELECT c_custkey, {_latlon_sql('c_custkey', 21, 22)} FROM customer),
s AS (SELECT s_suppkey, {_latlon_sql('s_suppkey', 23, 24)} FROM supplier),
p AS (SELECT c_custkey, s_suppkey, sqrt((c.lat - s.lat) * (c.lat - s.lat) + (c.lon - s.lon) * (c.lon - s.lon)) AS d
      FROM c, s)
SELECT c_custkey, arg_min(s_suppkey, (d, s_suppkey)) AS s_suppkey, min(d) AS distance FROM p GROUP BY c_custkey""")
def f41_nearest_place(t):
    c = _latlon(t.customer, "c_custkey", 21, 22)
    s = _latlon(t.supplier, "s_suppkey", 23, 24)
    n = N.nearest(c, s, "c_custkey", "s_suppkey", ["lat", "lon"])
    return n.select("c_custkey", "s_suppkey", "distance")


def _points(t):
    e = t.embeddings
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n)
                                         for i, n in enumerate(["x", "y", "z", "w"])])


_PTS_SQL = """p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
                   CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS w FROM embeddings)"""
_D3 = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


def _d3(a, b):
    return N.euclid([a.getField(c) for c in "xyz"], [b.getField(c) for c in "xyz"])


@register("j17_knn_self_join", "J17", "vec_id:i nb_id:i distance:f rank:i", sql=f"""
WITH {_PTS_SQL},
c AS (SELECT a.vec_id, b.vec_id AS nb_id, {_D3} AS distance FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, nb_id) AS rank FROM c) WHERE rank <= 5""")
def j17_knn_self_join(t):
    p = _points(t)
    r = p.withColumnRenamed("vec_id", "nb_id")
    return N.knn(p, r, "vec_id", "nb_id", ["x", "y", "z"], 5, _d3, by=["label"], exclude_self=True)


_MASK_SQL = f"""m AS (SELECT *, CASE WHEN {SQL_UNIFORM('vec_id', 13)} < 0.2 THEN NULL ELSE w END AS t FROM p)"""


def _top_sql(k, part=""):
    on = f" AND a.label = b.label" if part else ""
    return f"""(SELECT * FROM (SELECT a.vec_id, b.t, {_D3} AS d,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D3}, b.vec_id) AS rk
      FROM m a JOIN m b ON a.t IS NULL AND b.t IS NOT NULL{on}) WHERE rk <= {k})"""


@register("x12_knn_impute", "X12 X13 X14 X16 J18", "vec_id:i imp_mean:f imp_dist:f imp_median:f imp_part:f", sql=f"""
WITH {_PTS_SQL}, {_MASK_SQL},
k5 AS {_top_sql(5)}, k7 AS {_top_sql(7)}, kp AS {_top_sql(5, 'label')}
SELECT vec_id, imp_mean, imp_dist, imp_median, imp_part FROM
  (SELECT vec_id, avg(t) AS imp_mean, sum(t / greatest(d, 1e-12)) / sum(1 / greatest(d, 1e-12)) AS imp_dist
   FROM k5 GROUP BY vec_id)
  JOIN (SELECT vec_id, median(t) AS imp_median FROM k7 GROUP BY vec_id) USING (vec_id)
  JOIN (SELECT vec_id, avg(t) AS imp_part FROM kp GROUP BY vec_id) USING (vec_id)""")
def x12_knn_impute(t):
    p = _points(t).withColumn("t", F.when(uniform("vec_id", 13) < 0.2, F.lit(None)).otherwise(F.col("w")))
    known = p.where(F.col("t").isNotNull())
    miss = p.where(F.col("t").isNull())
    vals = known.select(F.col("vec_id").alias("nb_id"), F.col("t").alias("v"))
    ref = known.withColumnRenamed("vec_id", "nb_id")
    # one 7-NN search serves k=5 (mean, distance-weighted) and k=7 (median)
    nb = N.knn(miss, ref, "vec_id", "nb_id", ["x", "y", "z"], 7, _d3).join(vals, "nb_id")
    k5 = F.col("rank") <= 5
    wgt = 1 / F.greatest(F.col("distance"), F.lit(1e-12))
    a = nb.groupBy("vec_id").agg(F.avg(F.when(k5, F.col("v"))).alias("imp_mean"),
                                 (F.sum(F.when(k5, wgt * F.col("v"))) / F.sum(F.when(k5, wgt))).alias("imp_dist"),
                                 F.median("v").alias("imp_median"))
    part = N.knn_impute(p, "vec_id", "t", ["x", "y", "z"], 5, "mean", by=["label"]).withColumnRenamed("imputed", "imp_part")
    return a.join(part, "vec_id")


@register("x15_knn_impute_label", "X15 K9 J18", "vec_id:i label:i", sql=f"""
WITH {_PTS_SQL},
m AS (SELECT *, CASE WHEN {SQL_UNIFORM('vec_id', 17)} < 0.2 THEN NULL ELSE label END AS t FROM p),
k AS {_top_sql(5)},
c AS (SELECT vec_id, t AS label, count(*) AS n FROM k GROUP BY ALL)
SELECT vec_id, arg_min(label, (-n, label)) AS label FROM c GROUP BY vec_id""")
def x15_knn_impute_label(t):
    p = _points(t).withColumn("t", F.when(uniform("vec_id", 17) < 0.2, F.lit(None)).otherwise(F.col("label")))
    return N.knn_impute(p, "vec_id", "t", ["x", "y", "z"], 5, "mode").withColumnRenamed("imputed", "label")


# ---------------------------------------------------------------- whole vectors, nulls in features
def _vectors(t):
    return t.embeddings.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))


_VEC_SQL = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@register("j17_vector_self_join", "J17", "vec_id:i nb_id:i distance:f rank:i", sql=f"""
WITH {_VEC_SQL},
c AS (SELECT a.vec_id, b.vec_id AS nb_id, list_distance(a.v, b.v) AS distance
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, nb_id) AS rank FROM c) WHERE rank <= 5""")
def j17_vector_self_join(t):
    e = _vectors(t)
    return VN.knn_vectors(e, e.withColumnRenamed("vec_id", "nb_id"), 5, qid="vec_id", rid="nb_id", vector="v", by=["label"],
                          exclude_self=True)


@register("k09_vector_classifier", "K9 X15", "vec_id:i label:i", sql=f"""
WITH {_VEC_SQL},
m AS (SELECT *, {SQL_UNIFORM('vec_id', 17)} < 0.2 AS q FROM e),
c AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rk
      FROM m a JOIN m b ON a.q AND NOT b.q),
n AS (SELECT vec_id, label, count(*) AS n FROM c WHERE rk <= 210 GROUP BY ALL)
SELECT vec_id, arg_min(label, (-n, label)) AS label FROM n GROUP BY vec_id""")
def k09_vector_classifier(t):
    e = _vectors(t).withColumn("q", uniform("vec_id", 17) < 0.2)
    ref = e.where(~F.col("q")).select(F.col("vec_id").alias("nb_id"), "v", F.col("label").alias("_label"))
    nb = VN.knn_vectors(e.where("q"), ref, 210, qid="vec_id", rid="nb_id", vector="v")
    votes = nb.join(ref.select("nb_id", "_label"), "nb_id").groupBy("vec_id", "_label").count()
    return votes.groupBy("vec_id").agg(F.min_by("_label", F.struct(-F.col("count"), F.col("_label"))).alias("label"))


_NAN = range(1, 7)
_NAN_SQL = f"""x AS (SELECT vec_id, label, {", ".join(f"CASE WHEN {SQL_UNIFORM('vec_id', 30 + i)} < 0.25 THEN NULL "
            f"ELSE CAST(embedding[{i}] AS DOUBLE) END AS x{i}" for i in _NAN)} FROM embeddings)"""
_NAN_SUM = " + ".join(f"coalesce((a.x{i} - b.x{i}) * (a.x{i} - b.x{i}), 0)" for i in _NAN)
_NAN_N = " + ".join(f"CAST(a.x{i} IS NOT NULL AND b.x{i} IS NOT NULL AS INTEGER)" for i in _NAN)


def _nan_top_sql(k, part=""):
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, nb) AS rk FROM (
        SELECT a.vec_id, b.vec_id AS nb, b.x1 AS t, sqrt(6.0 / ({_NAN_N}) * ({_NAN_SUM})) AS d
        FROM x a JOIN x b ON a.x1 IS NULL AND b.x1 IS NOT NULL AND ({_NAN_N}) > 0{part})) WHERE rk <= {k})"""


@register("x12_nan_knn_impute", "X12 X13 X14 X16", "vec_id:i imp_mean:f imp_dist:f imp_median:f imp_part:f", sql=f"""
WITH {_NAN_SQL}, k5 AS {_nan_top_sql(5)}, k100 AS {_nan_top_sql(100)}, kp AS {_nan_top_sql(5, ' AND a.label = b.label')},
g AS (SELECT avg(x1) AS m FROM x),
a AS (SELECT vec_id, avg(t) AS imp_mean, sum(t / d) / sum(1 / d) AS imp_dist FROM k5 GROUP BY vec_id),
b AS (SELECT vec_id, median(t) AS imp_median FROM k100 GROUP BY vec_id),
c AS (SELECT vec_id, avg(t) AS imp_part FROM kp GROUP BY vec_id)
SELECT x.vec_id, coalesce(imp_mean, m) AS imp_mean, coalesce(imp_dist, m) AS imp_dist,
  coalesce(imp_median, m) AS imp_median, coalesce(imp_part, m) AS imp_part
FROM x CROSS JOIN g LEFT JOIN a USING (vec_id) LEFT JOIN b USING (vec_id) LEFT JOIN c USING (vec_id) WHERE x1 IS NULL""")
def x12_nan_knn_impute(t):
    cols = [f"x{i}" for i in _NAN]
    x = t.embeddings.select("vec_id", "label", *[
        F.when(uniform("vec_id", 30 + i) >= 0.25, F.col("embedding")[i - 1].cast("double")).alias(f"x{i}") for i in _NAN])
    whole = VN.nan_knn_impute(x, "vec_id", cols, "x1", {"imp_mean": ("mean", 5), "imp_dist": ("distance", 5),
                                                        "imp_median": ("median", 100)})
    return whole.join(VN.nan_knn_impute(x, "vec_id", cols, "x1", {"imp_part": ("mean", 5)}, by=["label"]), "vec_id")
