"""Evaluation metrics and cut-offs as set-oriented aggregates
(SURVEY 2.10 M1-M17).

Inputs are long tables (``by`` keys such as model or fold, an id, a label,
a prediction), so every model / fold is scored in one pass.  Metrics that
depend on the order of predictions (AMEX, AUC, ROC / PR cut-offs) use
skew-safe running sums, never a window over the whole table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running_sums
from .windows import average_rank


def _agg(df: DataFrame, by: Sequence[str], *exprs: Column) -> DataFrame:
    by = list(by)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


# ---------------------------------------------------------------- M2-M6
def smape_zero_safe(y, p) -> Column:
    """Row-level SMAPE x100, 0 when both are 0 (M4)."""
    y, p = F.col(y) if isinstance(y, str) else y, F.col(p) if isinstance(p, str) else p
    den = (F.abs(y) + F.abs(p)) / 2
    return F.when((y == 0) & (p == 0), F.lit(0.0)).otherwise(F.try_divide(F.abs(y - p), den)) * 100


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, RMSLE (M5), SMAPE zero-safe (M2) and SMAPE x200 with
    0/0 skipped (M3) in one aggregate."""
    e = F.col(y) - F.col(p)
    le = F.log1p(F.col(p)) - F.log1p(F.col(y))
    s3 = F.try_divide(F.abs(e), F.abs(F.col(y)) + F.abs(F.col(p)))
    out = _agg(df, by, F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.avg(le * le).alias("_msle"),
               F.avg(smape_zero_safe(y, p)).alias("smape"), (F.avg(s3) * 200).alias("smape200"))
    return out.withColumn("rmse", F.sqrt("mse")).withColumn("rmsle", F.sqrt("_msle")).drop("_msle")


def log_loss(df: DataFrame, y: str, p: str, by: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """Binary log loss with clipping (M6); also the loss of 1-p to detect
    inverted predictions."""
    q = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    ll = -(F.col(y) * F.ln(q) + (1 - F.col(y)) * F.ln(1 - q))
    ll_inv = -(F.col(y) * F.ln(1 - q) + (1 - F.col(y)) * F.ln(q))
    return _agg(df, by, F.avg(ll).alias("log_loss"), F.avg(ll_inv).alias("log_loss_inverted"))


def classification_metrics(df: DataFrame, y: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and F1 of predicted 0/1 labels (M9)."""
    tp = F.sum(((F.col(y) == 1) & (F.col(label) == 1)).cast("int"))
    fp = F.sum(((F.col(y) == 0) & (F.col(label) == 1)).cast("int"))
    fn = F.sum(((F.col(y) == 1) & (F.col(label) == 0)).cast("int"))
    out = _agg(df, by, F.avg((F.col(y) == F.col(label)).cast("double")).alias("accuracy"),
               tp.alias("_tp"), fp.alias("_fp"), fn.alias("_fn"))
    f1 = F.try_divide(2 * F.col("_tp"), 2 * F.col("_tp") + F.col("_fp") + F.col("_fn"))
    return out.withColumn("f1", f1.cast("double")).drop("_tp", "_fp", "_fn")


def apply_cutoff(p, cut) -> Column:
    """0/1 label from a cut-off (M14): ``np.where(p < cut, 0, 1)``."""
    c = cut if isinstance(cut, Column) else F.lit(cut)
    return F.when(F.col(p) < c, 0).otherwise(1)


# ---------------------------------------------------------------- M7 AUC
def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC AUC (M7) by the rank-sum formula with average ranks
    (ranks from skew-safe running counts of distinct scores); null for a group
    of one class."""
    by = list(by)
    r = average_rank(df.select(*by, y, p), p, out="_rank", groups=by)
    s = _agg(r, by, F.sum(F.when(F.col(y) == 1, F.col("_rank"))).alias("_rs"),
             F.sum(F.col(y)).cast("double").alias("_np"), F.count(F.lit(1)).alias("_n"))
    npos, nneg = F.col("_np"), F.col("_n") - F.col("_np")
    return s.select(*by, F.try_divide(F.col("_rs") - npos * (npos + 1) / 2, npos * nneg).alias("auc"))


# ---------------------------------------------------------------- M1 AMEX
def amex_metric(df: DataFrame, y: str, p: str, id_col: str, by: Sequence[str] = (),
                slices: int | None = None) -> DataFrame:
    """AMEX default metric (M1): 0.5 * (normalised weighted Gini + share of
    positives captured in the top 4 % of weight), negatives weighted 20.
    Ties in the prediction are ordered by ``id_col``."""
    by = list(by)
    base = df.select(*by, id_col, y, p).withColumn("_w", F.when(F.col(y) == 0, 20).otherwise(1)) \
             .withColumn("_wp", F.col(y) * F.col("_w"))
    cum = running_sums(base, [(p, "desc"), id_col], ["_w", "_wp"], groups=by, slices=slices, totals=True)
    rnd, lor = F.try_divide("cum__w", "tot__w"), F.try_divide("cum__wp", "tot__wp")
    g = _agg(cum, by, F.sum((lor - rnd) * F.col("_w")).alias("gini"),
             F.sum(F.when(F.col("cum__w") <= F.floor(F.lit(0.04) * F.col("tot__w")), F.col(y)).otherwise(0)).alias("_top"),
             F.sum(F.col(y)).cast("double").alias("_pos"), F.count_if(F.col(y) == 0).cast("double").alias("_neg"))
    # the best order has all positives first, so its curve follows from the two counts
    pos, neg = F.col("_pos"), F.col("_neg")
    w = pos + 20 * neg
    best = (pos + 1) / 2 * (1 - F.try_divide(pos, w)) + 20 * (neg - F.try_divide(neg * pos + 10 * neg * (neg + 1), w))
    norm, top = F.try_divide(F.col("gini"), best), F.try_divide("_top", "_pos")
    return g.select(*by, norm.alias("norm_gini"), top.alias("top4"), (0.5 * (norm + top)).alias("amex"))


# ---------------------------------------------------------------- M8 QWK
def quadratic_kappa(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Quadratic weighted kappa (M8) for consecutive integer classes, from
    one aggregate: 1 - sum (y-p)^2 / E, E = (n sum y^2 - 2 sum y sum p + n sum p^2) / n."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    s = _agg(df, by, F.count(F.lit(1)).cast("double").alias("n"), F.sum((yy - pp) * (yy - pp)).alias("o"),
             F.sum(yy).alias("sy"), F.sum(pp).alias("sp"), F.sum(yy * yy).alias("syy"), F.sum(pp * pp).alias("spp"))
    e = (F.col("n") * F.col("syy") - 2 * F.col("sy") * F.col("sp") + F.col("n") * F.col("spp"))
    return s.select(*list(by), (1 - F.try_divide(F.col("o") * F.col("n"), e)).alias("qwk"))


# ---------------------------------------------------------------- M11 calibration
def calibration_curve(df: DataFrame, y: str, p: str, n_bins: int = 20) -> DataFrame:
    """Quantile-bin calibration curve (M11, ``strategy='quantile'``): bin
    edges are exact percentiles of the predictions (a bounded list of
    ``n_bins - 1`` interior edges), bin = number of interior edges <= p."""
    from .aggregates import grouped_quantiles
    qs = {f"e{i}": i / n_bins for i in range(1, n_bins)}
    edges = grouped_quantiles(df, [], p, qs).first()
    arr = F.array(*[F.lit(float(edges[f"e{i}"])) for i in range(1, n_bins)])
    b = F.size(F.filter(arr, lambda e: e <= F.col(p)))
    return df.groupBy(b.alias("bin")).agg(F.avg(y).alias("prob_true"), F.avg(p).alias("prob_pred"),
                                          F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- M12 / M13 cut-offs
def _threshold_table(df: DataFrame, y: str, p: str, by: Sequence[str], slices: int | None):
    by = list(by)
    d = df.groupBy(*by, p).agg(F.sum(F.col(y)).alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    d = d.withColumn("_neg", F.col("_cnt") - F.col("_pos"))
    return running_sums(d, [(p, "desc")], ["_pos", "_neg"], groups=by, slices=slices, totals=True)


def roc_cutoff(df: DataFrame, y: str, p: str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Threshold closest to (FPR 0, TPR 1) over every distinct score (M12);
    ties go to the higher threshold."""
    by = list(by)
    t = _threshold_table(df, y, p, by, slices)
    tpr = F.try_divide("cum__pos", "tot__pos")
    fpr = F.try_divide("cum__neg", "tot__neg")
    dist = F.sqrt(fpr * fpr + (1 - tpr) * (1 - tpr))
    return _agg(t.withColumn("_d", dist), by,
                F.min_by(F.col(p), F.struct(F.col("_d"), -F.col(p))).alias("cutoff"), F.min("_d").alias("distance"))


def pr_cutoff(df: DataFrame, y: str, p: str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Threshold closest to (precision 1, recall 1) (M13) over the
    thresholds of the precision-recall curve (down to the first reaching
    full recall); ties go to the lower threshold."""
    by = list(by)
    t = _threshold_table(df, y, p, by, slices)
    prec = F.try_divide(F.col("cum__pos"), F.col("cum__pos") + F.col("cum__neg"))
    rec = F.try_divide("cum__pos", "tot__pos")
    # keep thresholds down to the first one with full recall
    first_full = F.col("cum__pos") - F.col("_pos") < F.col("tot__pos")
    dist = F.sqrt((1 - prec) * (1 - prec) + (1 - rec) * (1 - rec))
    return _agg(t.where(first_full).withColumn("_d", dist), by,
                F.min_by(F.col(p), F.struct(F.col("_d"), F.col(p))).alias("cutoff"), F.min("_d").alias("distance"))


# ---------------------------------------------------------------- M15 / M16
def fold_summary(scores: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population variance and std of fold scores."""
    return _agg(scores, by, F.avg(score).alias("mean"), F.var_pop(score).alias("var"),
                F.stddev_pop(score).alias("std"))


def split_metric(df: DataFrame, value: str, cond: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean of a row metric inside / outside a period."""
    return _agg(df, by, F.avg(F.when(cond, F.col(value))).alias("in_period"),
                F.avg(F.when(~cond, F.col(value))).alias("out_period"))
