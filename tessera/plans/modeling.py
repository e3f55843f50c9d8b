"""Preprocessing (X1-X22), model (K1-K19), selection (L1-L9), adversarial
validation (V8), stacking (E14) and text-embedding (F19) queries.

Encoders, scalers and fills have DuckDB oracles; model fits have none (the
driver records a rows-only check), but every fit reads whole driver tables.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import models as K
from ..operators import prep as X
from ..operators import select as L
from ..operators.ordering import uniform
from .registry import register
from .relational import SQL_UNIFORM

_FEATS = ["l_quantity", "l_discount", "l_tax", "price_k", "ship_year"]


def _lines(t):
    """Line items with numeric features and a 0/1 label (shipped status)."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        (F.col("l_extendedprice") / 1000).alias("price_k"), F.year("l_shipdate").cast("double").alias("ship_year"),
        (F.col("l_linestatus") == "F").cast("double").alias("label"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("row_id"))


# --------------------------------------------------------------------------- X1-X5, X9
@register("x01_encoders", "X1 X2 X3 X5 X9", "o_orderkey:i o_orderstatus_F:i o_orderstatus_O:i o_orderstatus_P:i "
          "dropfirst_O:i dropfirst_P:i prio_code:i year_code:i", sql="""
WITH tr AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) < 2000),
yc AS (SELECT y, row_number() OVER (ORDER BY y) - 1 AS code FROM tr),
pc AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS prio_code
       FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F, CAST(o_orderstatus = 'O' AS INTEGER)
  AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
  CAST(o_orderstatus = 'O' AS INTEGER) AS dropfirst_O, CAST(o_orderstatus = 'P' AS INTEGER) AS dropfirst_P,
  prio_code, coalesce(code, -1) AS year_code
FROM orders o JOIN pc USING (o_orderpriority) LEFT JOIN yc ON year(o.o_orderdate) = yc.y""")
def x01_encoders(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"))
    o = X.one_hot(o, "o_orderstatus")                                             # X1
    d = X.one_hot(o.select("o_orderkey", "o_orderstatus"), "o_orderstatus", drop_first=True, prefix="dropfirst")
    o = o.join(d.drop("o_orderstatus"), "o_orderkey")                             # X2
    o = X.label_encode(o, "o_orderpriority", "prio_code")                          # X3
    o = X.label_encode(o, "y", "year_code", fit=o.where(F.col("y") < 2000))        # X5 unseen -> -1
    return X.fill_constant(o, {"year_code": -1})                                   # X9


@register("x05_ordinal_default", "X5", "o_orderkey:i code:i", sql="""
WITH tr AS (SELECT * FROM orders WHERE year(o_orderdate) < 1996 AND o_orderpriority < '4'),
c AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
      FROM (SELECT DISTINCT o_orderpriority FROM tr)),
d AS (SELECT code FROM (SELECT code, count(*) AS n FROM tr JOIN c USING (o_orderpriority) GROUP BY code)
      ORDER BY n DESC, code LIMIT 1)
SELECT o_orderkey, coalesce(c.code, d.code) AS code FROM orders CROSS JOIN d LEFT JOIN c USING (o_orderpriority)""")
def x05_ordinal_default(t):
    """Codes learnt on the early orders of three priorities; a priority that
    they lack gets -1, which then becomes their commonest code."""
    o = t.orders.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    train = o.where((F.col("y") < 1996) & (F.col("o_orderpriority") < "4"))
    coded = X.label_encode(o, "o_orderpriority", "code", fit=train)
    coded = X.fill_constant(coded, {"code": -1})
    seen = X.label_encode(train, "o_orderpriority", "code").groupBy("code").count()
    default = seen.select(F.max_by("code", F.struct("count", -F.col("code")))).scalar()
    return coded.select("o_orderkey", F.when(F.col("code") == -1, default).otherwise(F.col("code")).alias("code"))


@register("x04_factorize", "X4", "event_type:s code:i", sql="""
SELECT event_type, row_number() OVER (ORDER BY first_ts, first_id) - 1 AS code FROM (
  SELECT event_type, min(ts) AS first_ts, arg_min(event_id, (ts, event_id)) AS first_id
  FROM events GROUP BY event_type)""")
def x04_factorize(t):
    return X.factorize(t.events, "event_type", ["ts", "event_id"], "code").select("event_type", "code").distinct()


_SPLIT = f"{SQL_UNIFORM('o_orderkey', 4)} < 0.8"


@register("x06_scaling", "X6 X7 X8", "o_orderkey:i price_mm:f price_rng:f price_z:f price_c:f", sql=f"""
WITH tr AS (SELECT * FROM orders WHERE {_SPLIT}),
s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd
      FROM tr)
SELECT o_orderkey, (o_totalprice - lo) / (hi - lo) AS price_mm, (o_totalprice - lo) / (hi - lo) * 2.8 AS price_rng,
  (o_totalprice - m) / sd AS price_z, o_totalprice - m AS price_c FROM orders, s""")
def x06_scaling(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    train = o.where(uniform("o_orderkey", 4) < 0.8)
    mm = X.fit_minmax(train, ["o_totalprice"])
    sd = X.fit_standard(train, ["o_totalprice"])
    o = X.minmax_scale(o, mm, suffix="_mm")
    o = X.minmax_scale(o, mm, 0.0, 2.8, suffix="_rng")
    o = X.standardize(o, sd, suffix="_z")
    o = X.standardize(o, sd, with_std=False, suffix="_c")
    return o.select("o_orderkey", F.col("o_totalprice_mm").alias("price_mm"), F.col("o_totalprice_rng").alias("price_rng"),
                    F.col("o_totalprice_z").alias("price_z"), F.col("o_totalprice_c").alias("price_c"))


@register("x11_low_value_fill", "X11 X10", "o_orderkey:i price:f was_low:i", sql="""
WITH g AS (SELECT o_orderstatus, o_orderpriority,
             CAST(sum(CAST(CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS DECIMAL(38,6))) AS DOUBLE)
             / count(CASE WHEN o_totalprice >= 50000 THEN o_totalprice END) AS gm
           FROM orders GROUP BY ALL)
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN gm ELSE o_totalprice END AS price,
  CAST(o_totalprice < 50000 AS INTEGER) AS was_low FROM orders JOIN g USING (o_orderstatus, o_orderpriority)""")
def x11_low_value_fill(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = o.withColumn("was_low", (F.col("o_totalprice") < 50000).cast("int"))
    f = X.fill_low_with_group_mean(o, "o_totalprice", ["o_orderstatus", "o_orderpriority"], 50000, out="price")
    return f.select("o_orderkey", "price", "was_low")


@register("x17_iterative_impute", "X17", "c_custkey:i c_acctbal:f n_orders:f", note="ml regression per column")
def x17_iterative_impute(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n_orders"))
    c = t.customer.join(per, t.customer.c_custkey == per.o_custkey, "left").select(
        "c_custkey", F.when(uniform("c_custkey", 5) < 0.1, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "n_orders", F.col("c_nationkey").cast("double").alias("nk"))
    return X.iterative_impute(c, ["c_acctbal", "n_orders", "nk"], iterations=2).select("c_custkey", "c_acctbal", "n_orders")


@register("x18_pca_scores", "X18 X21", "vec_id:i pc1:f pc2:f cum_var:f", note="ml PCA")
def x18_pca_scores(t):
    e = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    out, cum = X.add_pca(e, [f"e{i}" for i in range(64)], 2)
    return out.select("vec_id", "pc1", "pc2", F.lit(cum[-1]).alias("cum_var"))


@register("x19_kmeans_sweep", "X19 X20", "k:i inertia:f silhouette:f davies_bouldin:f calinski_harabasz:f",
          note="ml KMeans")
def x19_kmeans_sweep(t):
    e = t.embeddings.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    res = X.kmeans_sweep(e, [f"e{i}" for i in range(64)], [2, 4, 6])
    return t.embeddings.sparkSession.createDataFrame(
        [(r["k"], r["inertia"], r["silhouette"], r["davies_bouldin"], r["calinski_harabasz"]) for r in res],
        "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double")


@register("x22_knn_graph_clusters", "X22 J17", "id:i cluster:i", note="ml power iteration clustering")
def x22_knn_graph_clusters(t):
    from ..operators import vectors as VN
    e = t.embeddings.select("vec_id", F.col("embedding").alias("v"))
    nb = VN.knn_vectors(e, e.withColumnRenamed("vec_id", "nb_id"), 5, qid="vec_id", rid="nb_id", vector="v", exclude_self=True)
    # an edge that both ends name counts once
    edges = nb.select(F.least("vec_id", "nb_id").alias("a"), F.greatest("vec_id", "nb_id").alias("b"),
                      F.exp(-F.col("distance")).alias("w")).groupBy("a", "b").agg(F.max("w").alias("w"))
    return X.knn_graph_clusters(edges, "a", "b", "w", 4).select("id", "cluster")


@register("x18_out_of_fold_pca", "X18 X21", "fold:i n_train:i total_var:f explained_all:f axes_error:f score_ss:f", sql=f"""
WITH e AS (SELECT CAST(floor({SQL_UNIFORM('vec_id', 3)} * 5) AS INTEGER) AS fold, embedding FROM embeddings),
x AS (SELECT fold, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS d FROM e),
p AS (SELECT fold, d, count(*) AS n, sum(CAST(v AS DOUBLE)) AS s, sum(CAST(v AS DOUBLE) * v) AS q FROM x GROUP BY ALL),
t AS (SELECT d, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM p GROUP BY d),
o AS (SELECT p.*, t.n - p.n AS m, (t.s - p.s) / (t.n - p.n) AS mean, (t.q - p.q) / (t.n - p.n) AS sq FROM p JOIN t USING (d))
SELECT fold, max(m) AS n_train, sum(sq - mean * mean) AS total_var, 1.0 AS explained_all, 0.0 AS axes_error,
  sum(q - 2 * mean * s + n * mean * mean) AS score_ss FROM o GROUP BY fold""")
def x18_out_of_fold_pca(t):
    """Checked facts of the out-of-fold scores: the training rows and variance
    of each fold, the share that all axes explain, how far the axes are from
    orthonormal, and the squares of the fold's scores on all axes."""
    import numpy as np
    e = t.embeddings.select("vec_id", "embedding", F.floor(uniform("vec_id", 3) * 5).cast("int").alias("fold"))
    scored, fits = X.out_of_fold_pca(e, "embedding", "fold", 64)
    rows = [(f, int(n), float(var.sum()), float(np.cumsum(var / var.sum())[-1]),
             float(np.abs(axes.T @ axes - np.eye(len(var))).max())) for f, (n, _, var, axes) in fits.items()]
    facts = e.sparkSession.createDataFrame(rows, "fold int, n_train long, total_var double, explained_all double, "
                                                 "axes_error double")
    squares = F.aggregate("scores", F.lit(0.0), lambda s, v: s + v * v)
    return scored.groupBy("fold").agg(F.sum(squares).alias("score_ss")).join(facts, "fold")


# --------------------------------------------------------------------------- models
@register("k01_linear_family", "K1 K15 K2 K18 K11 L7", "model:s feature:s coef:f", note="ml linear models")
def k01_linear_family(t):
    li = _lines(t)
    spark = li.sparkSession
    rows = []
    for name, reg, l1 in [("ols", 0.0, 0.0), ("ridge", 0.1, 0.0), ("lasso", 0.01, 1.0), ("elastic", 0.01, 0.5)]:
        m = K.fit_linear(li, ["l_quantity", "l_discount", "l_tax"], "price_k", reg, l1)
        rows += [(name, f, c) for f, c in K.coefficients(m, ["l_quantity", "l_discount", "l_tax"])]
    wl = K.balanced_weights(li, "label")
    for name, pen in [("logistic_l2", "l2"), ("logistic_l1", "l1")]:
        m = K.fit_logistic(wl, _FEATS, "label", C=1.0, penalty=pen, weight="weight")
        rows += [(name, f, c) for f, c in K.coefficients(m, _FEATS)]
    svm = K.fit_classifier(li, _FEATS, "label", "svm", maxIter=20)
    rows += [("linear_svm", f, c) for f, c in K.coefficients(svm, _FEATS)]
    lt = K.log_target_fit(li.where(F.col("price_k") > 0), ["l_quantity"], "price_k", factor=1.003)
    rows.append(("log_target_mean_pred", "all", float(lt.agg(F.avg("prediction")).first()[0])))
    return spark.createDataFrame(rows, "model string, feature string, coef double")


@register("k03_trees_and_ensembles", "K3 K4 K5 L3", "model:s feature:s importance:f", note="ml trees")
def k03_trees_and_ensembles(t):
    from ..session import cut_lineage
    # every level of every forest and boosting round reads the rows: made once, in the same partitions
    li = cut_lineage(_lines(t).select("label", *_FEATS))
    spark = li.sparkSession
    rows = []
    tree = K.fit_classifier(li, _FEATS, "label", "tree", maxDepth=3)
    rows += [("tree_depth3", f, v) for f, v in K.importances(tree, _FEATS)]
    rf = K.fit_classifier(li, _FEATS, "label", "forest", numTrees=20, maxDepth=5)
    rows += [("forest", f, v) for f, v in K.importances(rf, _FEATS)]
    extra = K.extra_trees(li, _FEATS, "label", trees=100, depth=5)
    rows += [("extra_trees", f, v) for f, v in extra.importances().items()]
    gbt = K.fit_classifier(li, _FEATS, "label", "gbt", maxIter=10, maxDepth=3)
    rows += [("gbt", f, v) for f, v in K.importances(gbt, _FEATS)]
    mi = L.mean_importance(li, _FEATS, "label", repeats=2).collect()
    rows += [("forest_mean2", r["feature"], r["importance"]) for r in mi]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


@register("k06_multiclass", "K6 K7 M9", "model:s accuracy:f", note="ml multiclass")
def k06_multiclass(t):
    li = _lines(t).withColumn("cls", F.when(F.col("l_returnflag") == "A", 0.0)
                              .when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0))
    spark = li.sparkSession
    out = []
    ovr = K.fit_classifier(li, _FEATS, "cls", "ovr")
    mlp = K.fit_classifier(li, _FEATS, "cls", "mlp", layers=[len(_FEATS), 8, 3], maxIter=30)
    x = K.assemble(li, _FEATS)
    for name, m in [("one_vs_rest", ovr), ("mlp", mlp)]:
        acc = m.transform(x).agg(F.avg((F.col("prediction") == F.col("cls")).cast("double"))).first()[0]
        out.append((name, float(acc)))
    return spark.createDataFrame(out, "model string, accuracy double")


@register("k08_calibration", "K8 K19", "doc_id:i raw:f calibrated:f", note="ml isotonic calibration")
def k08_calibration(t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("y"), F.ln("n_chars").alias("x"))
    basis = K.hinge_basis("x", [5.0, 6.0, 7.0, 8.0])
    d = d.withColumns(basis)
    d = d.withColumn("part", F.floor(uniform("doc_id", 8) * 4).cast("int"))
    return K.cross_calibrated(d.where("part < 3"), d.where("part = 3"), ["x", *basis.keys()], "y", "part", 3) \
        .select("doc_id", "raw", "calibrated")


@register("k10_lda", "K10", "lda_class:i n:i", note="closed-form LDA from aggregates")
def k10_lda(t):
    li = _lines(t)
    fit = K.lda_fit(li, _FEATS, "label")
    return K.lda_predict(li, fit).groupBy(F.col("lda_class").cast("int").alias("lda_class")).agg(
        F.count(F.lit(1)).alias("n"))


@register("k12_segment_models", "K12 K13", "o_custkey:i intercept:f trend:f sin1:f cos1:f",
          note="per-segment least squares from grouped sufficient statistics")
def k12_segment_models(t):
    m = t.orders.groupBy("o_custkey", ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1)
                         .alias("period")).agg((F.sum("o_totalprice") / 1000).alias("v"))
    feats, names = K.seasonal_design(F.col("period"), 12.0, 1)
    return K.segment_ridge(m, ["o_custkey"], feats, names, "v", reg=1e-3)


@register("k14_grid_search", "K14 V1", "reg:f l1:f rmse:f", note="elastic nets from sums by a hash fold column")
def k14_grid_search(t):
    from ..operators.validate import kfold
    li = kfold(_lines(t).select("row_id", "l_quantity", "l_discount", "l_tax", "price_k"), "row_id", 3, seed=1)
    res = K.grid_search(li, ["l_quantity", "l_discount", "l_tax"], "price_k", "fold", [0.0, 0.1], [0.0, 1.0])
    return li.sparkSession.createDataFrame(res, "reg double, l1 double, rmse double")


@register("k16_two_phase_bagging", "K16 K17 E1", "o_custkey:i bagged:f", note="ml two-phase + seed bagging")
def k16_two_phase_bagging(t):
    o = t.orders.select("o_orderkey", "o_custkey", (F.col("o_totalprice") / 1000).alias("y"),
                        F.month("o_orderdate").cast("double").alias("m"),
                        F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"))
    phase1 = K.fit_linear(o, ["m", "prio"], "y").transform(K.assemble(o, ["m", "prio"])) \
        .select("o_orderkey", F.round("prediction").alias("p1"))
    o2 = o.join(phase1, "o_orderkey")
    b = K.bagged_predictions(o2, ["m", "prio", "p1"], "y", seeds=range(100), id_col="o_orderkey", keep=["o_custkey"])
    # a customer meets all predictions of its orders' keys, should a key repeat: their sums, not their pairs
    key = Window.partitionBy("o_orderkey")
    met = b.repartition("o_orderkey").groupBy("o_orderkey", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bagged").alias("s"), F.count("bagged").alias("c")).select(
        "o_custkey", (F.col("n") * F.sum("s").over(key)).alias("s"), (F.col("n") * F.sum("c").over(key)).alias("c"))
    return met.groupBy("o_custkey").agg((F.sum("s") / F.nullif(F.sum("c"), F.lit(0))).alias("bagged"))


@register("v08_adversarial_validation", "V8 M7", "auc:f", note="ml forest on source labels")
def v08_adversarial_validation(t):
    li = _lines(t)
    a = li.where(uniform("l_orderkey", 1) < 0.7)
    b = li.where(uniform("l_orderkey", 1) >= 0.7)
    return li.sparkSession.createDataFrame([(K.adversarial_auc(a, b, _FEATS, "row_id"),)], "auc double")


@register("e14_stacking", "E14 V7", "model:s auc:f", note="ml meta-model on out-of-fold predictions")
def e14_stacking(t):
    from ..operators.metrics import roc_auc
    from ..operators.validate import kfold
    from ..session import cut_lineage, stage_rows
    # the fold-assigned table feeds 3 folds x 2 fits: cut its lineage once (shared checkpoint folder), without the
    # columns that no fit reads
    li = cut_lineage(kfold(_lines(t), "row_id", 3, seed=2).select("row_id", "label", *_FEATS, "fold"))
    base = []
    for f in range(3):
        tr, te = li.where(F.col("fold") != f), li.where(F.col("fold") == f)
        m1 = K.fit_logistic(tr, _FEATS, "label")
        m2 = K.fit_classifier(tr, _FEATS, "label", "tree", maxDepth=4)
        # both models score a line where it lies
        one = K.positive_probability(m1.transform(K.assemble(te, _FEATS)), "p_lr").drop("rawPrediction", "probability", "prediction")
        base.append(K.positive_probability(m2.transform(one), "p_tree").select("row_id", "label", "p_lr", "p_tree", "fold"))
    from functools import reduce
    scored = stage_rows(reduce(lambda a, b: a.unionByName(b), base), "stacking")
    oof = stage_rows(scored.select("row_id", "fold", "label", "p_lr").join(scored.select("row_id", "fold", "p_tree"),
                                                                           ["row_id", "fold"]).drop("row_id"), "stacked")
    # the meta-model, too, is scored on a fold that it has not seen
    parts = []
    for f in range(3):
        meta = K.fit_logistic(oof.where(F.col("fold") != f), ["p_lr", "p_tree"], "label")
        parts.append(K.positive_probability(meta.transform(K.assemble(oof.where(F.col("fold") == f), ["p_lr", "p_tree"])))
                     .select("label", "p"))
    st = reduce(lambda a, b: a.unionByName(b), parts)
    long = (oof.select(F.lit("lr").alias("model"), "label", F.col("p_lr").alias("pred"))
            .unionByName(oof.select(F.lit("tree").alias("model"), "label", F.col("p_tree").alias("pred")))
            .unionByName(st.select(F.lit("stack").alias("model"), "label", F.col("p").alias("pred"))))
    return roc_auc(long, "label", "pred", by=["model"])


# --------------------------------------------------------------------------- selection
@register("l01_rfe_votes", "L1", "feature:s votes:i pct:f", note="elimination by cross-validated AMEX metric, 25 repeats")
def l01_rfe_votes(t):
    return L.rfe_votes(_lines(t), _FEATS, "label", "row_id", keep=3, step=1, repeats=25, folds=3, trees=10, depth=3)


@register("l02_merged_votes", "L2", "feature:s votes:i pct:f", sql="""
WITH v AS (SELECT o_orderpriority AS feature, year(o_orderdate) AS run, avg(o_totalprice) AS m FROM orders GROUP BY ALL),
s AS (SELECT feature, run, m > (SELECT avg(o_totalprice) FROM orders) AS sel FROM v)
SELECT feature, count(*) AS votes, 100.0 * count(*) / (SELECT count(DISTINCT run) FROM s) AS pct
FROM s WHERE sel GROUP BY feature""")
def l02_merged_votes(t):
    """One selection file per order year: the priorities whose mean price is
    above that of all orders; their votes over the files."""
    o = t.orders.select("o_orderpriority", F.year("o_orderdate").alias("run"), "o_totalprice")
    mean = o.select(F.avg("o_totalprice")).scalar()
    per = o.groupBy(F.col("o_orderpriority").alias("Variable"), "run").agg(
        (F.avg("o_totalprice") > mean).cast("int").alias("Selected"))
    runs = sorted(r["run"] for r in o.select("run").distinct().collect())     # calendar years
    return L.merge_vote_files([per.where(F.col("run") == r).drop("run") for r in runs])


@register("l04_null_importance", "L4 O8", "feature:s score_log:f score_pct:f", note="forest on permuted target")
def l04_null_importance(t):
    return L.null_importance(_lines(t), _FEATS, "label", "row_id", runs=50)


@register("l05_permutation_importance", "L5", "feature:s importance_mean:f importance_std:f", note="ml + permutation")
def l05_permutation_importance(t):
    import numpy as np
    li = _lines(t)
    m = K.fit_logistic(li, _FEATS, "label")
    w, c = m.coefficients.toArray(), float(m.intercept)

    def predict(x):
        return 1 / (1 + np.exp(-(x @ w + c)))

    def log_loss(y, p):
        p = np.clip(p, 1e-15, 1 - 1e-15)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p))
    return L.permutation_importance(li, _FEATS, "label", "row_id", predict, log_loss, repeats=50)


@register("l06_prune_models", "L6 A28 M6", "model:s spearman:f loss:f", sql="""
WITH d AS (SELECT l.doc_id, l.quality AS y, 1 / (1 + exp(-(ln(dd.n_chars) - 7))) AS plen,
             CAST(('0x' || substr(md5(CAST(l.doc_id AS VARCHAR) || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 AS phash
           FROM labels l JOIN documents dd ON l.doc_id = dd.doc_id),
preds AS (SELECT 'len' AS model, doc_id, y, plen AS pred FROM d UNION ALL SELECT 'hash', doc_id, y, phash FROM d
          UNION ALL SELECT 'mix', doc_id, y, (plen + phash) / 2 FROM d),
r AS (SELECT model, doc_id, rank() OVER (PARTITION BY model ORDER BY pred)
        + (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS rk FROM preds),
c AS (SELECT r.model, corr(r.rk, ref.rk) AS spearman FROM r JOIN (SELECT doc_id, rk FROM r WHERE model = 'len') ref
      USING (doc_id) GROUP BY r.model),
l AS (SELECT model, avg(-(y * ln(least(greatest(pred, 1e-15), 1 - 1e-15))
        + (1 - y) * ln(1 - least(greatest(pred, 1e-15), 1 - 1e-15)))) AS loss FROM preds GROUP BY model)
SELECT model, spearman, loss FROM c JOIN l USING (model) WHERE spearman <= 0.98 AND loss <= 0.9""")
def l06_prune_models(t):
    from ..operators.metrics import log_loss
    from .evaluation import _preds
    p = _preds(t)
    losses = log_loss(p, "y", "pred", by=["model"]).select("model", F.col("log_loss").alias("loss"))
    return L.prune_models(p, losses, "len", "doc_id", 0.98, 0.9)


@register("l08_variance_filter", "L8", "feature:s var:f", sql="""
SELECT * FROM (SELECT 'l_quantity' AS feature, var_pop(l_quantity) AS var FROM lineitem
  UNION ALL SELECT 'l_discount', var_pop(l_discount) FROM lineitem UNION ALL SELECT 'l_tax', var_pop(l_tax) FROM lineitem)
WHERE var > 0.0005""")
def l08_variance_filter(t):
    li = t.lineitem
    cols = ["l_quantity", "l_discount", "l_tax"]
    keep = L.low_variance(li, cols, 0.0005)
    v = li.agg(*[F.var_pop(c).alias(c) for c in cols]).unpivot([], cols, "feature", "var")
    return v.where(F.col("feature").isin(keep))


@register("l09_nested_topk", "L9 L7", "k:i features:s auc:f", note="ml nested feature sets")
def l09_nested_topk(t):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    li = _lines(t)
    ev = BinaryClassificationEvaluator(labelCol="label")
    res = L.nested_topk_scores(li, _FEATS, "label", [2, 3], lambda m, x: ev.evaluate(m.transform(x)))
    return li.sparkSession.createDataFrame(res, "k int, features string, auc double")


# --------------------------------------------------------------------------- F19
_W2V = 16


@register("f19_word2vec_lda", "F19", " ".join(["doc_id:i topic:i", *[f"w2v_{j}:f" for j in range(_W2V)]]),
          note="skip-gram vectors in blocks, a document's mean vector + ml LDA")
def f19_word2vec_lda(t):
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer
    from pyspark.ml.functions import vector_to_array
    from ..functions.text import words
    from ..operators import embed as E
    from ..operators.ordering import argmax_class
    from ..session import cut_lineage
    d = t.documents.select("doc_id", words(F.lower("text")).alias("tokens"))
    d = cut_lineage(d)                                    # three learners read the tokens
    d.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")       # rows hold whole texts
    blocks = E.token_blocks(d, "doc_id", "tokens")
    vectors = E.word_vectors(blocks, size=_W2V, min_count=5, seed=1)
    cv = CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=2000, minDF=2).fit(d)
    x = cv.transform(d)
    lda = LDA(k=5, maxIter=5, seed=1, featuresCol="tf").fit(x)
    # a document's vector and topic are made of the same row, since ids may repeat
    placed = lda.transform(cv.transform(E.document_vectors(blocks, vectors, "doc_id", "tokens", "w2v")))
    return placed.select("doc_id", argmax_class(vector_to_array("topicDistribution")).alias("topic"),
                         *[F.col("w2v")[j].alias(f"w2v_{j}") for j in range(_W2V)])
