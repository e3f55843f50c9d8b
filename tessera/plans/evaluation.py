"""Metric, validation and ensemble queries.

Predictions come from the driver tables: ``labels.quality`` is the target;
model "len" scores documents by a logistic of log length, "hash" by a
seeded hash of the id, "mix" averages both.  Everything is long form
(model, doc_id, y, pred).
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ensemble as E
from ..operators import metrics as M
from ..operators import validate as V
from ..operators.ordering import uniform
from ..operators.prefix import exact_sum
from .registry import ESUM, register
from .relational import SQL_HASH, SQL_UNIFORM

_PRED_SQL = f"""d AS (SELECT l.doc_id, l.quality AS y, 1 / (1 + exp(-(ln(dd.n_chars) - 7))) AS plen,
                {SQL_UNIFORM('l.doc_id', 1)} AS phash FROM labels l JOIN documents dd ON l.doc_id = dd.doc_id),
preds AS (SELECT 'len' AS model, doc_id, y, plen AS pred FROM d UNION ALL SELECT 'hash', doc_id, y, phash FROM d
          UNION ALL SELECT 'mix', doc_id, y, (plen + phash) / 2 FROM d)"""


def _wide(t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return d.select("doc_id", F.col("quality").alias("y"),
                    (1 / (1 + F.exp(-(F.ln("n_chars") - 7)))).alias("plen"), uniform("doc_id", 1).alias("phash"))


def _preds(t):
    w = _wide(t)
    return (w.select(F.lit("len").alias("model"), "doc_id", "y", F.col("plen").alias("pred"))
            .unionByName(w.select(F.lit("hash").alias("model"), "doc_id", "y", F.col("phash").alias("pred")))
            .unionByName(w.select(F.lit("mix").alias("model"), "doc_id", "y",
                                  ((F.col("plen") + F.col("phash")) / 2).alias("pred"))))


def _gini_sql(order: str) -> str:
    return f"""(SELECT model, sum((cwp / twp - cw / tw) * w) AS gini,
      sum(CASE WHEN cw <= floor(0.04 * tw) THEN y ELSE 0 END) AS top, sum(y) AS pos FROM (
        SELECT model, y, w, sum(w) OVER (PARTITION BY model ORDER BY {order} DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cw,
               sum(w) OVER (PARTITION BY model) AS tw,
               sum(y * w) OVER (PARTITION BY model ORDER BY {order} DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cwp,
               sum(y * w) OVER (PARTITION BY model) AS twp
        FROM (SELECT *, CASE WHEN y = 0 THEN 20 ELSE 1 END AS w FROM preds)) GROUP BY model)"""


@register("m01_amex_metric", "M1 W13 O5", "model:s norm_gini:f top4:f amex:f", sql=f"""
WITH {_PRED_SQL}, g AS {_gini_sql('pred')}, gm AS {_gini_sql('y')}
SELECT model, g.gini / gm.gini AS norm_gini, g.top / g.pos AS top4, 0.5 * (g.gini / gm.gini + g.top / g.pos) AS amex
FROM g JOIN gm USING (model)""")
def m01_amex_metric(t):
    return M.amex_metric(_preds(t), "y", "pred", "doc_id", by=["model"])


_NAIVE_SQL = """n AS (SELECT o_orderstatus, o_orderdate, o_totalprice / 1000 AS y,
       lag(o_totalprice / 1000) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders)"""


def _naive(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    k = F.col("o_totalprice") / 1000             # prices in thousands
    return t.orders.select("o_orderstatus", "o_orderdate", "o_orderkey", k.alias("y"),
                           F.lag(k).over(w).alias("p")).where(F.col("p").isNotNull())


@register("m02_regression_metrics", "M2 M3 M4 M5", "o_orderstatus:s mse:f mae:f smape:f smape200:f rmse:f rmsle:f",
          sql=f"""
WITH {_NAIVE_SQL}
SELECT o_orderstatus, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
  avg(CASE WHEN y = 0 AND p = 0 THEN 0.0 ELSE abs(y - p) / ((abs(y) + abs(p)) / 2) END * 100) AS smape,
  avg(abs(y - p) / nullif(abs(y) + abs(p), 0)) * 200 AS smape200,
  sqrt(avg((y - p) * (y - p))) AS rmse, sqrt(avg((ln(1 + p) - ln(1 + y)) * (ln(1 + p) - ln(1 + y)))) AS rmsle
FROM n WHERE p IS NOT NULL GROUP BY o_orderstatus""")
def m02_regression_metrics(t):
    return M.regression_metrics(_naive(t), "y", "p", by=["o_orderstatus"])


@register("m06_log_loss", "M6", "model:s log_loss:f log_loss_inverted:f", sql=f"""
WITH {_PRED_SQL}, q AS (SELECT model, y, least(greatest(pred, 1e-15), 1 - 1e-15) AS q FROM preds)
SELECT model, avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS log_loss,
  avg(-(y * ln(1 - q) + (1 - y) * ln(q))) AS log_loss_inverted FROM q GROUP BY model""")
def m06_log_loss(t):
    return M.log_loss(_preds(t), "y", "pred", by=["model"])


@register("m07_roc_auc", "M7 W14", "model:s auc:f", sql=f"""
WITH {_PRED_SQL},
r AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY pred)
        + (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS rk FROM preds)
SELECT model, (sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc
FROM r GROUP BY model""")
def m07_roc_auc(t):
    return M.roc_auc(_preds(t), "y", "pred", by=["model"])


@register("m08_quadratic_kappa", "M8", "qwk:f", sql="""
WITH c AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS y,
                  least(5, CAST(floor(o_totalprice / 100000) AS INTEGER) + 1) AS p FROM orders)
SELECT 1 - sum((y - p) * (y - p)) / ((count(*) * sum(y * y) - 2 * sum(y) * sum(p) + count(*) * sum(p * p)) / count(*))
  AS qwk FROM c""")
def m08_quadratic_kappa(t):
    c = t.orders.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("y"),
                        F.least(F.lit(5), F.floor(F.col("o_totalprice") / 100000).cast("int") + 1).alias("p"))
    return M.quadratic_kappa(c, "y", "p")


@register("m09_accuracy_f1", "M9 M14", "model:s accuracy:f f1:f", sql=f"""
WITH {_PRED_SQL}, l AS (SELECT model, y, CASE WHEN pred < 0.5 THEN 0 ELSE 1 END AS lab FROM preds)
SELECT model, avg(CAST(y = lab AS DOUBLE)) AS accuracy,
  2.0 * count(*) FILTER (WHERE y = 1 AND lab = 1) / (2 * count(*) FILTER (WHERE y = 1 AND lab = 1)
    + count(*) FILTER (WHERE y = 0 AND lab = 1) + count(*) FILTER (WHERE y = 1 AND lab = 0)) AS f1
FROM l GROUP BY model""")
def m09_accuracy_f1(t):
    p = _preds(t).withColumn("lab", M.apply_cutoff("pred", 0.5))
    return M.classification_metrics(p, "y", "lab", by=["model"])


@register("m11_calibration", "M11", "bin:i prob_true:f prob_pred:f n:i", sql=f"""
WITH {_PRED_SQL}, p AS (SELECT * FROM preds WHERE model = 'len'),
e AS (SELECT quantile_cont(pred, [{', '.join(str(i / 20) for i in range(1, 20))}]) AS edges FROM p)
SELECT len(list_filter(edges, lambda x: x <= pred)) AS bin, avg(y) AS prob_true, avg(pred) AS prob_pred, count(*) AS n
FROM p, e GROUP BY ALL""")
def m11_calibration(t):
    return M.calibration_curve(_preds(t).where(F.col("model") == "len"), "y", "pred", 20)


@register("m12_roc_cutoff", "M12", "model:s cutoff:f distance:f", sql=f"""
WITH {_PRED_SQL}, thr AS (SELECT model, pred, sum(y) AS pos, count(*) - sum(y) AS neg FROM preds GROUP BY ALL),
c AS (SELECT model, pred, sum(pos) OVER w / sum(pos) OVER (PARTITION BY model) AS tpr,
             sum(neg) OVER w / sum(neg) OVER (PARTITION BY model) AS fpr
      FROM thr WINDOW w AS (PARTITION BY model ORDER BY pred DESC ROWS UNBOUNDED PRECEDING))
SELECT model, arg_min(pred, (sqrt(fpr * fpr + (1 - tpr) * (1 - tpr)), -pred)) AS cutoff,
  min(sqrt(fpr * fpr + (1 - tpr) * (1 - tpr))) AS distance FROM c GROUP BY model""")
def m12_roc_cutoff(t):
    return M.roc_cutoff(_preds(t), "y", "pred", by=["model"])


@register("m13_pr_cutoff", "M13", "model:s cutoff:f distance:f", sql=f"""
WITH {_PRED_SQL}, thr AS (SELECT model, pred, sum(y) AS pos, count(*) - sum(y) AS neg FROM preds GROUP BY ALL),
c AS (SELECT model, pred, pos, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER (PARTITION BY model) AS tp
      FROM thr WINDOW w AS (PARTITION BY model ORDER BY pred DESC ROWS UNBOUNDED PRECEDING)),
k AS (SELECT model, pred, sqrt((1 - cp / (cp + cn)) * (1 - cp / (cp + cn)) + (1 - cp / tp) * (1 - cp / tp)) AS dist
      FROM c WHERE cp - pos < tp)
SELECT model, arg_min(pred, (dist, pred)) AS cutoff, min(dist) AS distance FROM k GROUP BY model""")
def m13_pr_cutoff(t):
    return M.pr_cutoff(_preds(t), "y", "pred", by=["model"])


def _kfold_sql(k: int, seed: int) -> str:
    return f"""(SELECT *, CASE WHEN r < (n % {k}) * (n // {k} + 1) THEN r // (n // {k} + 1)
                  ELSE (n % {k}) + (r - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS fold
       FROM (SELECT *, row_number() OVER (ORDER BY {SQL_HASH('o_orderkey', seed)}, o_orderkey) - 1 AS r,
                    count(*) OVER () AS n FROM orders))"""


@register("v01_kfold", "V1", "o_orderkey:i fold:i", sql=f"SELECT o_orderkey, fold FROM {_kfold_sql(5, 42)}")
def v01_kfold(t):
    return V.kfold(t.orders.select("o_orderkey"), "o_orderkey", 5, seed=42)


@register("m15_fold_summary", "M15 V1 M5", "mean:f var:f std:f", sql=f"""
WITH f AS (SELECT *, o_totalprice / 1000 AS y FROM {_kfold_sql(5, 42)}),
fm AS (SELECT fold, ((SELECT {ESUM('y')} FROM f) - {ESUM('y')}) / ((SELECT count(*) FROM f) - count(*)) AS m
       FROM f GROUP BY fold),
s AS (SELECT fold, sqrt(avg((y - m) * (y - m))) AS rmse FROM f JOIN fm USING (fold) GROUP BY fold)
SELECT avg(rmse) AS mean, var_pop(rmse) AS var, stddev_pop(rmse) AS std FROM s""")
def m15_fold_summary(t):
    f = V.kfold(t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("y")), "o_orderkey", 5, seed=42)
    # fold model = mean of the other folds' values (prices in thousands), from exact sums
    s = f.groupBy("fold").agg(exact_sum("y").alias("sf"), F.count(F.lit(1)).alias("nf"))
    tot = f.agg(F.struct(exact_sum("y").alias("st"), F.count(F.lit(1)).alias("nt"))).scalar()
    m = s.withColumn("m", (tot.getField("st") - F.col("sf")) / (tot.getField("nt") - F.col("nf")))
    e = f.join(m.select("fold", "m"), "fold").groupBy("fold").agg(
        F.sqrt(F.avg((F.col("y") - F.col("m")) ** 2)).alias("rmse"))
    return M.fold_summary(e, "rmse")


@register("m16_split_metric", "M16 M4", "o_orderstatus:s in_period:f out_period:f", sql=f"""
WITH {_NAIVE_SQL}
SELECT o_orderstatus,
  avg(CASE WHEN month(o_orderdate) <= 3 THEN CASE WHEN y = 0 AND p = 0 THEN 0.0 ELSE abs(y - p) / ((abs(y) + abs(p)) / 2) END * 100 END) AS in_period,
  avg(CASE WHEN month(o_orderdate) > 3 THEN CASE WHEN y = 0 AND p = 0 THEN 0.0 ELSE abs(y - p) / ((abs(y) + abs(p)) / 2) END * 100 END) AS out_period
FROM n WHERE p IS NOT NULL GROUP BY o_orderstatus""")
def m16_split_metric(t):
    n = _naive(t).withColumn("s", M.smape_zero_safe("y", "p"))
    return M.split_metric(n, "s", F.month("o_orderdate") <= 3, by=["o_orderstatus"])


@register("v02_stratified_kfold", "V2", "o_orderkey:i fold:i", sql=f"""
SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {SQL_HASH('o_orderkey', 7)}, o_orderkey) - 1)
  % 5 AS INTEGER) AS fold FROM orders""")
def v02_stratified_kfold(t):
    return V.stratified_kfold(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 5, 7) \
        .select("o_orderkey", "fold")


@register("v02_repeated_folds", "V2", "repeat:i o_orderkey:i fold:i", sql="\nUNION ALL\n".join(f"""
SELECT {r} AS repeat, o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY {SQL_HASH('o_orderkey', 20 + r)}, o_orderkey) - 1) % 4 AS INTEGER) AS fold FROM orders""" for r in range(3)))
def v02_repeated_folds(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return V.repeated_stratified_kfold(o, "o_orderkey", "o_orderstatus", 4, 3, seed=20).select("repeat", "o_orderkey", "fold")


@register("v03_group_kfold", "V3", "year:i n:i fold:i", sql="""
WITH s AS (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, year) - 1 AS i FROM s)
SELECT year, n, CASE WHEN (i // 4) % 2 = 0 THEN i % 4 ELSE 3 - i % 4 END AS fold FROM r""")
def v03_group_kfold(t):
    o = t.orders.select(F.year("o_orderdate").alias("year"))
    g = V.group_kfold(o, "year", 4)
    return g.groupBy("year", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("v04_leave_one_out", "V4", "c_custkey:i loo_mean:f", sql="""
SELECT c_custkey, (sum(c_acctbal) OVER w - c_acctbal) / nullif(count(*) OVER w - 1, 0) AS loo_mean
FROM customer WINDOW w AS (PARTITION BY c_nationkey)""")
def v04_leave_one_out(t):
    c = V.leave_one_out(t.customer, "c_custkey")
    g = c.groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"), F.count(F.lit(1)).alias("n"))
    j = c.join(g, "c_nationkey")
    return j.select("c_custkey", F.try_divide(F.col("s") - F.col("c_acctbal"), (F.col("n") - 1).cast("double"))
                    .alias("loo_mean"))


_SERIES_SQL = f"""m AS (SELECT o_custkey, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS period,
                  {ESUM('o_totalprice')} AS v FROM orders GROUP BY ALL)"""


@register("v05_walk_forward_naive", "V5 V6 M2 J19", "cut:i n:i smape:f", sql=f"""
WITH {_SERIES_SQL},
cuts AS (SELECT unnest(range(60, 79)) AS cut),
last AS (SELECT cut, o_custkey, arg_max(v, period) AS lastv FROM m JOIN cuts ON m.period <= cut GROUP BY ALL),
test AS (SELECT cut, o_custkey, v FROM m JOIN cuts ON m.period = cut + 1)
SELECT cut, count(*) AS n,
  avg(CASE WHEN v = 0 AND lastv = 0 THEN 0.0 ELSE abs(v - lastv) / ((abs(v) + abs(lastv)) / 2) END * 100) AS smape
FROM test JOIN last USING (cut, o_custkey) GROUP BY cut""")
def v05_walk_forward_naive(t):
    m = t.orders.groupBy("o_custkey", ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1)
                         .alias("period")).agg(exact_sum("o_totalprice").alias("v"))
    f = V.walk_forward(m, "period", 60, 78, last_of=["o_custkey"])
    last = f.where(F.col("role") == "train").select("cut", "o_custkey", F.col("v").alias("lastv"))
    test = f.where(F.col("role") == "test").select("cut", "o_custkey", "v")
    j = test.join(last, ["cut", "o_custkey"])
    return j.groupBy("cut").agg(F.count(F.lit(1)).alias("n"), F.avg(M.smape_zero_safe("v", "lastv")).alias("smape"))


@register("v07_out_of_fold", "V7", "o_orderkey:i fold:i oof:f", sql=f"""
WITH f AS {_kfold_sql(5, 42)},
g AS (SELECT o_orderpriority, sum(o_totalprice) AS gs, count(*) AS gn FROM f GROUP BY ALL),
gf AS (SELECT o_orderpriority, fold, sum(o_totalprice) AS sf, count(*) AS nf FROM f GROUP BY ALL)
SELECT o_orderkey, fold, (gs - sf) / nullif(gn - nf, 0) AS oof FROM f JOIN g USING (o_orderpriority)
  JOIN gf USING (o_orderpriority, fold)""")
def v07_out_of_fold(t):
    f = V.kfold(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderkey", 5, seed=42)
    return V.out_of_fold_group_mean(f, "fold", "o_orderpriority", "o_totalprice").select("o_orderkey", "fold", "oof")


@register("v07_fold_mean_test", "V7", "o_orderkey:i pred:f", sql=f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice, {SQL_UNIFORM('o_orderkey', 9)} AS u FROM orders),
tr AS (SELECT *, CAST(floor(u / 0.7 * 4) AS INTEGER) AS fold FROM o WHERE u < 0.7),
g AS (SELECT o_orderpriority, sum(o_totalprice) AS gs, count(*) AS gn FROM tr GROUP BY ALL),
gf AS (SELECT o_orderpriority, fold, sum(o_totalprice) AS sf, count(*) AS nf FROM tr GROUP BY ALL),
m AS (SELECT o_orderpriority, sum((gs - sf) / nullif(gn - nf, 0)) / 4 AS pred FROM gf JOIN g USING (o_orderpriority) GROUP BY ALL)
SELECT o_orderkey, pred FROM o LEFT JOIN m USING (o_orderpriority) WHERE u >= 0.7""")
def v07_fold_mean_test(t):
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", uniform("o_orderkey", 9).alias("u"))
    train = o.where("u < 0.7").withColumn("fold", F.floor(F.col("u") / 0.7 * 4).cast("int"))
    return V.fold_mean_test(o.where("u >= 0.7"), train, "fold", "o_orderpriority", "o_totalprice", 4).select(
        "o_orderkey", "pred")


_MONTHS = """SELECT o_custkey, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS period,
  sum(o_totalprice) / 1000 AS v FROM orders GROUP BY ALL"""
_TREND_SQL = f"""m AS ({_MONTHS}),
c AS (SELECT o_custkey, max(period) - 6 AS cut FROM m GROUP BY o_custkey),
f AS (SELECT o_custkey, regr_slope(v, CAST(period AS DOUBLE)) AS trend, regr_intercept(v, CAST(period AS DOUBLE)) AS intercept,
        arg_max(v, period) AS naive FROM m JOIN c USING (o_custkey) WHERE period <= cut GROUP BY o_custkey
      HAVING count(DISTINCT period) >= 3)"""


def _trend_fits(t):
    """Monthly sales per customer, a trend line of each customer's months but
    the last six, and the last value before them."""
    from ..operators import models as K
    m = t.orders.groupBy("o_custkey", ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).alias("period")) \
        .agg((F.sum("o_totalprice") / 1000).alias("v"))
    m = m.join(m.groupBy("o_custkey").agg((F.max("period") - 6).alias("cut")), "o_custkey")
    train = m.where("period <= cut")
    naive = train.groupBy("o_custkey").agg(F.max_by("v", "period").alias("naive"), F.count("*").alias("n")).where("n >= 3")
    feats = [F.col("period").cast("double")]
    fits = K.segment_ridge(train.join(naive.select("o_custkey"), "o_custkey", "left_semi"), ["o_custkey"], feats, ["trend"], "v")
    test = m.where("period > cut").join(naive.drop("n"), "o_custkey")
    return K.apply_segment_model(test, fits, ["o_custkey"], feats, ["trend"])


@register("k13_segment_forecast", "K12 K13", "o_custkey:i period:i v:f prediction:f", sql=f"""
WITH {_TREND_SQL}
SELECT o_custkey, period, v, round(intercept + trend * period, 4) AS prediction
FROM m JOIN c USING (o_custkey) JOIN f USING (o_custkey) WHERE period > cut""")
def k13_segment_forecast(t):
    return _trend_fits(t).select("o_custkey", "period", "v", F.round("prediction", 4).alias("prediction"))


@register("m17_model_vs_naive", "M17", "o_custkey:i n:i miss_rate:f", sql=f"""
WITH {_TREND_SQL}
SELECT o_custkey, count(*) AS n,
  avg(CASE WHEN abs(v - (intercept + trend * period)) > abs(v - naive) THEN 1.0 ELSE 0.0 END) AS miss_rate
FROM m JOIN c USING (o_custkey) JOIN f USING (o_custkey) WHERE period > cut GROUP BY o_custkey""")
def m17_model_vs_naive(t):
    """Per customer, the share of held-out months in which the model's error
    is larger than that of repeating the last known value."""
    worse = F.abs(F.col("v") - F.col("prediction")) > F.abs(F.col("v") - F.col("naive"))
    return _trend_fits(t).groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg(worse.cast("double")).alias("miss_rate"))


# --------------------------------------------------------------------------- ensembles
_W = {"len": 0.5, "hash": 0.2, "mix": 0.3}


@register("e01_blends", "E1 E2 E3 E4 E5", "doc_id:i mean:f hmean:f gmean:f fixed:f inverse:f proportional:f",
          sql=f"""
WITH {_PRED_SQL},
ll AS (SELECT model, avg(-(y * ln(least(greatest(pred, 1e-15), 1 - 1e-15))
          + (1 - y) * ln(1 - least(greatest(pred, 1e-15), 1 - 1e-15)))) AS score FROM preds GROUP BY model),
wi AS (SELECT model, (1 / score) / sum(1 / score) OVER () AS w FROM ll),
wp AS (SELECT model, score / sum(score) OVER () AS w FROM ll),
wf AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in _W.items())}) AS t(model, w))
SELECT doc_id, avg(pred) AS mean, count(pred) / sum(1 / pred) AS hmean, exp(avg(ln(pred))) AS gmean,
  sum(wf.w * pred) AS fixed, sum(wi.w * pred) AS inverse, sum(wp.w * pred) AS proportional
FROM preds JOIN wf USING (model) JOIN wi USING (model) JOIN wp USING (model) GROUP BY doc_id""")
def e01_blends(t):
    p = _preds(t)
    spark = p.sparkSession
    scores = M.log_loss(p, "y", "pred", by=["model"]).select("model", F.col("log_loss").alias("score"))
    fixed = spark.createDataFrame(list(_W.items()), "model string, fixed double")
    w = (fixed.join(E.inverse_score_weights(scores).withColumnRenamed("weight", "inverse"), "model")
              .join(E.proportional_weights(scores).withColumnRenamed("weight", "proportional"), "model"))
    blends = E.weighted_blend(p, w, "doc_id", weight=["fixed", "inverse", "proportional"])
    return E.mean_blend(p, "doc_id").join(blends, "doc_id")


@register("e06_rank_average", "E6 W14", "doc_id:i rank_mean:f", sql=f"""
WITH {_PRED_SQL},
r AS (SELECT doc_id, rank() OVER (PARTITION BY model ORDER BY pred)
        + (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS rk FROM preds)
SELECT doc_id, avg(rk) AS rank_mean FROM r GROUP BY doc_id""")
def e06_rank_average(t):
    return E.rank_average(_preds(t), "doc_id")


@register("e07_least_squares_weights", "E7", "model:s weight:f", sql=f"""
WITH {_PRED_SQL}, w AS (SELECT y, plen AS a, phash AS b FROM d),
s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS byy FROM w)
SELECT 'len' AS model, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS weight FROM s
UNION ALL SELECT 'hash', (aa * byy - ab * ay) / (aa * bb - ab * ab) FROM s""")
def e07_least_squares_weights(t):
    w = _wide(t)
    ws = E.least_squares_weights(w, "y", ["plen", "phash"])
    spark = w.sparkSession
    return spark.createDataFrame([("len", ws["plen"]), ("hash", ws["phash"])], "model string, weight double")


@register("e08_optimized_rounder", "E8", "cut_index:i cut:f", note="driver coordinate search on a bounded bin table")
def e08_optimized_rounder(t):
    o = t.orders.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("y"),
                        (F.col("o_totalprice") / 100000).alias("p"))
    cuts = E.optimized_rounder(o, "y", "p", [1, 2, 3, 4, 5], bins=100)
    return o.sparkSession.createDataFrame(list(enumerate(cuts)), "cut_index int, cut double")


_TH = [round(0.90 + 0.01 * i, 2) for i in range(9)]


@register("e09_pseudo_label_sweep", "E9", "threshold:f n_confident:i", sql=f"""
WITH p AS (SELECT {SQL_UNIFORM('doc_id', 1)} AS p FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
th AS (SELECT unnest([{', '.join(map(str, _TH))}]) AS threshold)
SELECT threshold, count(*) FILTER (WHERE p >= threshold OR p <= 1 - threshold) AS n_confident FROM th, p
GROUP BY threshold""")
def e09_pseudo_label_sweep(t):
    un = t.documents.join(t.labels, "doc_id", "left_anti").select(uniform("doc_id", 1).alias("p"))
    return E.pseudo_label_sweep(un, "p", _TH)


_ST = [0.5, 0.52, 0.55, 0.6, 0.7]


@register("e09_self_training", "E9", "threshold:f n_confident:i mse:f mse_before:f", sql=f"""
WITH d AS (SELECT d.doc_id, ln(greatest(n_chars, 1)) AS x, l.quality AS y, {SQL_UNIFORM('d.doc_id', 6)} < 0.3 AS valid
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d WHERE y IS NOT NULL AND NOT valid),
u AS (SELECT x, least(greatest(a + b * x, 0), 1) AS p FROM d, f WHERE y IS NULL),
th AS (SELECT unnest([{', '.join(map(str, _ST))}]) AS t),
rows AS (SELECT t, x, CAST(y AS DOUBLE) AS y, 0 AS new FROM d, th WHERE y IS NOT NULL AND NOT valid
         UNION ALL SELECT t, x, CAST(p >= 0.5 AS DOUBLE), 1 FROM u, th WHERE greatest(p, 1 - p) >= t),
g AS (SELECT t, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sum(new) AS n FROM rows GROUP BY t)
SELECT t AS threshold, n AS n_confident,
  (SELECT avg(pow(y - least(greatest(g.a + g.b * x, 0), 1), 2)) FROM d WHERE y IS NOT NULL AND valid) AS mse,
  (SELECT avg(pow(y - least(greatest(f.a + f.b * x, 0), 1), 2)) FROM d, f WHERE y IS NOT NULL AND valid) AS mse_before
FROM g""")
def e09_self_training(t):
    d = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.ln(F.greatest(F.col("n_chars"), F.lit(1))).alias("x"), F.col("quality").cast("double").alias("y"),
        (uniform("doc_id", 6) < 0.3).alias("valid"))
    known = F.col("y").isNotNull()
    return E.self_training_sweep(d.where(known & ~F.col("valid")), d.where(~known), d.where(known & F.col("valid")), ["x"],
                                 "y", _ST)


@register("e11_disaggregation", "E11 A25 A30", "month:i n_nationkey:i p_type:s forecast:f", sql=f"""
WITH s AS (SELECT month(l.l_shipdate) AS month, n.n_nationkey, p.p_type, l.l_extendedprice AS v
           FROM lineitem l JOIN supplier su ON l.l_suppkey = su.s_suppkey JOIN nation n ON su.s_nationkey = n.n_nationkey
           JOIN part p ON l.l_partkey = p.p_partkey),
base AS (SELECT month, n_nationkey, p_type, {ESUM('v')} AS v FROM s GROUP BY ALL),
cells AS (SELECT DISTINCT month, n_nationkey, p_type FROM base),
tot AS (SELECT month, sum(v) AS total FROM base GROUP BY month),
ns AS (SELECT n_nationkey, sum(v) / (SELECT sum(v) FROM base) AS ns FROM base GROUP BY n_nationkey),
ts AS (SELECT n_nationkey, p_type, sum(v) / sum(sum(v)) OVER (PARTITION BY n_nationkey) AS ts FROM base
       GROUP BY n_nationkey, p_type)
SELECT month, n_nationkey, p_type, round_even(total * ns * ts, 0) AS forecast
FROM cells JOIN tot USING (month) JOIN ns USING (n_nationkey) JOIN ts USING (n_nationkey, p_type)""")
def e11_disaggregation(t):
    from pyspark.sql import Window
    li = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey") \
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    # the one pass over the fact table: sales at the finest grain (month x nation x type, bounded by the calendar
    # and the dimensions); totals and shares below are computed on this small table
    base = li.groupBy(F.month("l_shipdate").alias("month"), F.col("s_nationkey").alias("n_nationkey"), "p_type") \
        .agg(exact_sum("l_extendedprice").alias("v"))
    total = base.groupBy("month").agg(F.sum("v").alias("total"))
    nat = base.groupBy("n_nationkey").agg(F.sum("v").alias("_nv"))
    ns = nat.select("n_nationkey", (F.col("_nv") / F.sum("_nv").over(Window.partitionBy())).alias("ns"))
    nt = base.groupBy("n_nationkey", "p_type").agg(F.sum("v").alias("_v"))
    ts = nt.select("n_nationkey", "p_type", (F.col("_v") / F.sum("_v").over(Window.partitionBy("n_nationkey"))).alias("ts"))
    cells = base.select("month", "n_nationkey", "p_type").join(total, "month")
    d = E.disaggregate(cells, [(ns, ["n_nationkey"], "ns"), (ts, ["n_nationkey", "p_type"], "ts")], "total", "forecast")
    return d.select("month", "n_nationkey", "p_type", "forecast")


@register("e15_disagreement_override", "E15 M14", "doc_id:i label:i", sql=f"""
WITH {_PRED_SQL}
SELECT doc_id, CASE WHEN (plen >= 0.5) <> (phash >= 0.5) THEN CAST((plen + phash) / 2 >= 0.5 AS INTEGER)
  ELSE CAST(plen >= 0.5 AS INTEGER) END AS label FROM d""")
def e15_disagreement_override(t):
    w = _wide(t)
    a = M.apply_cutoff("plen", 0.5)
    b = M.apply_cutoff("phash", 0.5)
    c = F.when((F.col("plen") + F.col("phash")) / 2 < 0.5, 0).otherwise(1)
    return w.select("doc_id", E.disagreement_override(a, b, c).alias("label"))
