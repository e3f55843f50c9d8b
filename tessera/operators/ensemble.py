"""Prediction blending and post-processing.

Predictions are kept long — (id, model, pred) — so any number of models
blends in one grouped aggregate; weight tables have one row per model
(bounded by the number of models) and are broadcast.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mean_blend(preds: DataFrame, key: str, pred: str = "pred") -> DataFrame:
    """Arithmetic (E1), harmonic and geometric (E5) means per id; the last two
    are 0 where a prediction is 0."""
    zero = F.coalesce(F.bool_or(F.col(pred) == 0), F.lit(False))
    return preds.groupBy(key).agg(
        F.avg(pred).alias("mean"),
        F.when(zero, 0.0).otherwise(F.try_divide(F.count(pred), F.sum(F.try_divide(F.lit(1.0), F.col(pred)))))
        .alias("hmean"),
        F.when(zero, 0.0).otherwise(F.exp(F.avg(F.ln(pred)))).alias("gmean"))


def weighted_blend(preds: DataFrame, weights: DataFrame, key: str, model: str = "model",
                   pred: str = "pred", weight: str = "weight") -> DataFrame:
    """sum(w * p) per id with a (model, weight) table (E2, E3, E4).  The
    weight table has one row per model and may carry several weight columns
    (``weight`` a name or a list): all blends come from one aggregate."""
    ws = [weight] if isinstance(weight, str) else list(weight)
    j = preds.join(F.broadcast(weights), model)
    aggs = [F.sum(F.col(w) * F.col(pred)).alias("blend" if isinstance(weight, str) else w) for w in ws]
    return j.groupBy(key).agg(*aggs)


def inverse_score_weights(scores: DataFrame, model: str = "model", score: str = "score") -> DataFrame:
    """Weights proportional to 1/score, normalised to sum 1; a failed model
    (null or non-positive score) gets weight 0 (E3)."""
    inv = F.when(F.col(score) > 0, 1 / F.col(score)).otherwise(F.lit(0.0))
    s = scores.select(model, inv.alias("_inv"))
    # one row per model: the normalising window spans a table bounded by the model count
    return s.select(model, F.try_divide(F.col("_inv"), F.sum("_inv").over(Window.partitionBy())).alias("weight"))


def proportional_weights(scores: DataFrame, model: str = "model", score: str = "score") -> DataFrame:
    """Weights proportional to the score itself (E4).  For an error score
    this favours the worse model; kept as in the reference, as an option."""
    return scores.select(model, F.try_divide(F.col(score), F.sum(score).over(Window.partitionBy())).alias("weight"))


def rank_average(preds: DataFrame, key: str, model: str = "model", pred: str = "pred") -> DataFrame:
    """Rank-average blend (E6): average rank within each model (skew-safe),
    then the mean rank per id."""
    from .windows import average_rank
    r = average_rank(preds.select(key, model, pred), pred, out="_rank", groups=[model])
    return r.groupBy(key).agg(F.avg("_rank").alias("rank_mean"))


def least_squares_weights(wide: DataFrame, y: str, models: Sequence[str]) -> dict[str, float]:
    """Linear blend weights minimising squared error (E7): the normal
    equations X'X w = X'y come from one aggregate (k^2 + k sums); the k x k
    solve runs on the driver (k = number of models)."""
    import numpy as np
    ms = list(models)
    row = wide.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"xx_{i}_{j}") for i, a in enumerate(ms)
                     for j, b in enumerate(ms)],
                   *[F.sum(F.col(a) * F.col(y)).alias(f"xy_{i}") for i, a in enumerate(ms)]).first()
    k = len(ms)
    xtx = np.array([[row[f"xx_{i}_{j}"] for j in range(k)] for i in range(k)], dtype=float)
    xty = np.array([row[f"xy_{i}"] for i in range(k)], dtype=float)
    w = np.linalg.solve(xtx, xty)
    return dict(zip(ms, map(float, w)))


def optimized_rounder(scored: DataFrame, y: str, p: str, classes: Sequence[int], bins: int = 200,
                      sweeps: int = 3) -> list[float]:
    """Ordinal cut points maximising quadratic weighted kappa.

    Scores are binned once (``width_bucket``) into a (bin, label) count
    table — at most ``bins x classes`` rows regardless of data size — and a
    coordinate search over bin edges runs on that small table on the driver.
    """
    import numpy as np
    lo, hi = scored.agg(F.min(p), F.max(p)).first()
    b = F.width_bucket(F.col(p), F.lit(lo), F.lit(hi + 1e-12), F.lit(bins))
    tab = scored.groupBy(b.alias("bin"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
    cls = list(classes)
    counts = np.zeros((bins + 2, len(cls)))
    for r in tab:
        counts[r["bin"], cls.index(r["y"])] += r["n"]
    edges = lo + (hi - lo) * np.arange(bins + 1) / bins          # bin i covers [edges[i-1], edges[i])

    def kappa(cuts_idx):
        pred_cls = np.searchsorted(np.array(cuts_idx), np.arange(bins + 2), side="right")
        conf = np.zeros((len(cls), len(cls)))
        for bi in range(bins + 2):
            conf[:, pred_cls[bi]] += counts[bi]
        n = conf.sum()
        w = (np.subtract.outer(np.arange(len(cls)), np.arange(len(cls))) ** 2)
        e = np.outer(conf.sum(1), conf.sum(0)) / n
        return 1 - (w * conf).sum() / (w * e).sum()

    cuts = list(np.linspace(1, bins, len(cls) + 1)[1:-1].round().astype(int))
    for _ in range(sweeps):
        for i in range(len(cuts)):
            lo_i = cuts[i - 1] if i else 1
            hi_i = cuts[i + 1] if i + 1 < len(cuts) else bins
            best = max(range(lo_i, hi_i + 1), key=lambda c: kappa(cuts[:i] + [c] + cuts[i + 1:]))
            cuts[i] = best
    return [float(edges[c - 1]) for c in cuts]


def apply_cuts(p, cuts: Sequence[float], classes: Sequence[int]) -> Column:
    """Map a score to an ordinal class with cut points."""
    e = F.lit(classes[0])
    for c, k in zip(cuts, classes[1:]):
        e = F.when(F.col(p) >= c, F.lit(k)).otherwise(e)
    return e


def pseudo_label_sweep(preds: DataFrame, p: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows confidently predicted (p >= t or p <= 1 - t) per threshold (E9),
    one aggregate with one column per threshold (the list is fixed)."""
    wide = preds.agg(*[F.count_if((F.col(p) >= t) | (F.col(p) <= 1 - t)).alias(f"t{i}")
                       for i, t in enumerate(thresholds)])
    long = wide.unpivot([], [f"t{i}" for i in range(len(thresholds))], "k", "n_confident")
    th = F.element_at(F.array(*[F.lit(float(t)) for t in thresholds]),
                      F.regexp_extract("k", r"(\d+)$", 1).cast("int") + 1)
    return long.select(th.alias("threshold"), "n_confident")


def _products(features: Sequence[str], y: Column) -> list[Column]:
    """Sums of products of (1, features, y): the whole of a least-squares fit."""
    v = [F.lit(1.0), *[F.col(f).cast("double") for f in features], y]
    return [F.sum(v[i] * v[j]).alias(f"s{i}_{j}") for i in range(len(v)) for j in range(i, len(v))]


def self_training_sweep(train: DataFrame, unlabelled: DataFrame, valid: DataFrame, features: Sequence[str], label: str,
                        thresholds: Sequence[float]) -> DataFrame:
    """Pseudo-labelling with a refit and a metric per threshold (E9):
    (threshold, n_confident, mse, mse_before).

    A least-squares classifier of a 0/1 label is fitted to ``train`` and scores
    ``unlabelled``; rows whose larger class probability reaches a threshold
    join the training set with that class, and the refit is scored on
    ``valid``.  The confident sets are nested, so each unlabelled row counts
    once, for the highest threshold that it reaches: all refits come from one
    aggregate by that number, and all scores from one more."""
    import numpy as np
    features, levels = list(features), sorted(float(t) for t in thresholds)
    spark, size = train.sparkSession, len(features) + 2

    def matrix(row) -> np.ndarray:
        m = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                m[i, j] = m[j, i] = row[f"s{i}_{j}"] or 0.0
        return m

    def solve(m: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(m[:-1, :-1], m[:-1, -1], rcond=None)[0]

    def probability(w) -> Column:
        p = F.lit(float(w[0]))
        for f, c in zip(features, w[1:]):
            p = p + F.col(f) * F.lit(float(c))
        return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
    base = matrix(train.agg(*_products(features, F.col(label).cast("double"))).first())
    p = probability(solve(base))
    sure = F.greatest(p, 1 - p)
    rank = reduce(lambda a, b: a + b, [(sure >= t).cast("int") for t in levels])
    got = unlabelled.where(p.isNotNull()).groupBy(rank.alias("rank")).agg(
        *_products(features, (p >= 0.5).cast("double")), F.count(F.lit(1)).alias("n")).collect()   # one row a threshold
    sums, n = [np.zeros((size, size)) for _ in range(len(levels) + 1)], [0] * (len(levels) + 1)
    for r in got:
        sums[r["rank"]], n[r["rank"]] = matrix(r), r["n"]
    fits = [solve(base + sum(sums[i + 1:], np.zeros((size, size)))) for i in range(len(levels))]

    def mse(w) -> Column:
        e = F.col(label).cast("double") - probability(w)
        return F.avg(e * e)
    score = valid.agg(*[mse(w).alias(f"m{i}") for i, w in enumerate([solve(base), *fits])]).first()
    return spark.createDataFrame([(t, sum(n[i + 1:]), score[i + 1], score[0]) for i, t in enumerate(levels)],
                                 "threshold double, n_confident long, mse double, mse_before double")


def disaggregate(total: DataFrame, shares: Sequence[tuple[DataFrame, Sequence[str], str]],
                 value: str, out: str, decimals: int = 0) -> DataFrame:
    """Top-down disaggregation (E11): total x share_1 x share_2 ...; each share
    table is (keys..., share) and joined on its keys; result rounded half to
    even like numpy."""
    d = total
    shares_cols = []
    for tab, keys, col in shares:
        d = d.join(tab, list(keys), "inner")
        shares_cols.append(F.col(col))
    v = F.col(value)
    for s in shares_cols:
        v = v * s
    return d.withColumn(out, F.bround(v, decimals))


def disagreement_override(a: Column, b: Column, c: Column) -> Column:
    """``np.where(p1 != p2, p3, p1)``."""
    return F.when(a != b, c).otherwise(a)
