"""Group aggregates.

All functions are ``DataFrame -> DataFrame`` and build one declarative plan.
Order-sensitive statistics take an explicit order key; exact quantiles and
"above own mean" shares are computed from a de-duplicated (group, value)
table with skew-safe running counts (see ``prefix``), never by collecting a
group's rows into one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import as_exact, exact_sum, order_key
from .quantiles import exact_quantiles, exact_quantiles_of_columns, quantile_of, ranked_values


def _cols(xs) -> list:
    return [xs] if isinstance(xs, str) else list(xs)


# ---------------------------------------------------------------- A13 / A1-A4, A8, A10-A12
def panel_summary(df: DataFrame, keys, value: str, order: Sequence[str],
                  slices: int | None = None) -> DataFrame:
    """Per-entity summary row (A13): n, mean, median, min, max, range, IQR,
    std (ddof 1), MAD, count positive, count / share above own mean, last value.

    Groups of one row get 0 for range, IQR, std and share above mean, as in
    the reference summary function.  ``last`` is positional (by ``order``) and
    keeps a null last value.
    """
    keys = _cols(keys)
    x, v = as_exact(value), F.col(value)
    profile = [F.sum(x).alias("_sum"), F.sum(v.cast("double")).alias("_sum_double"),
               (F.count(x) < F.count(v)).alias("_lossy"), F.max_by(v, order_key(df, order)).alias("_last")]

    def per_row(get):
        n, lossy = get("_n"), get("_lossy")
        dev = v - F.try_divide(F.when(lossy, get("_sum_double")).otherwise(get("_sum").cast("double")), n)
        # n*v - S in decimal: exact sign for "above mean" and exact MAD numerator
        ndev = x * n - get("_sum")
        return [F.sum(dev * dev).alias("_ss"), F.sum(F.when(~lossy, F.abs(ndev))).alias("_sad"),
                F.sum(F.when(lossy, F.abs(dev))).alias("_sad_lossy"), F.count_if(v > 0).alias("_pos"),
                F.count_if(F.when(lossy, dev > 0).otherwise(ndev > 0)).alias("_above"),
                F.min(v).alias("_min"), F.max(v).alias("_max")]
    names = ["_sum", "_sum_double", "_lossy", "_last"]
    fr = ranked_values(df.select(*dict.fromkeys([*keys, value, *order])), keys, value, [0.25, 0.5, 0.75], profile,
                       per_row, names)
    mean = F.try_divide(F.when(F.any_value("_lossy"), F.any_value("_sum_double")).otherwise(
        F.any_value("_sum").cast("double")), F.max("tot__c"))
    agg = fr.groupBy(*keys).agg(
        F.max("tot__c").alias("n"),
        mean.alias("mean"),
        quantile_of(value, 0.5).alias("median"),
        quantile_of(value, 0.25).alias("q1"),
        quantile_of(value, 0.75).alias("q3"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
        F.sum("_ss").alias("_ss"),
        F.sum("_sad").alias("_sad"),
        F.sum("_sad_lossy").alias("_sad_lossy"),
        F.sum("_pos").alias("count_positive"),
        F.sum("_above").alias("count_above_mean"),
        F.any_value("_last").alias("last"),
    )
    one = F.col("n") == 1
    return agg.select(
        *keys, "n", "mean", "median", "min", "max",
        F.when(one, 0.0).otherwise(F.col("max") - F.col("min")).alias("range"),
        F.when(one, 0.0).otherwise(F.col("q3") - F.col("q1")).alias("iqr"),
        F.when(one, 0.0).otherwise(F.sqrt(F.try_divide("_ss", F.col("n") - 1))).alias("std"),
        F.coalesce(F.try_divide(F.col("_sad").cast("double"), F.col("n") * F.col("n")),
                   F.try_divide("_sad_lossy", "n")).alias("mad"),
        "count_positive", "count_above_mean",
        F.when(one, 0.0).otherwise(F.try_divide("count_above_mean", "n")).alias("pct_above_mean"),
        "last",
    )


# ---------------------------------------------------------------- exact quantiles per group
def grouped_quantiles(df: DataFrame, keys, value: str, qs: dict[str, float],
                      slices: int | None = None, approx: int | None = None) -> DataFrame:
    """Exact linearly-interpolated quantiles of ``value`` per ``keys`` (empty
    keys = whole table), e.g. ``{"median": .5, "q1": .25}``.  Built on the
    distinct-value frame with skew-safe running counts: no group is collected
    into one task and memory does not grow with a group's size.

    ``approx=accuracy`` uses Spark's mergeable GK sketch instead
    (``percentile_approx``: bounded memory per group, one partial aggregate,
    rank error <= n / accuracy, returns observed values).  Use it when the
    distinct (group, value) table is itself too large to rank."""
    keys = _cols(keys)
    if approx:
        pa = F.percentile_approx(value, [float(q) for q in qs.values()], approx)
        g = df.groupBy(*keys).agg(pa.alias("_q")) if keys else df.agg(pa.alias("_q"))
        return g.select(*keys, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(qs)])
    return exact_quantiles(df, keys, value, qs)


def block_iqr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One IQR over a whole block of columns flattened together."""
    long = df.unpivot([], list(cols), "_var", "_v").select(F.col("_v").cast("double").alias("_v"))
    q = grouped_quantiles(long, [], "_v", {"q1": 0.25, "q3": 0.75})
    return q.select((F.col("q3") - F.col("q1")).alias("iqr"))


def spearman(df: DataFrame, a: str, b: str, id_col: str | None = None) -> DataFrame:
    """Spearman correlation (A28): Pearson over average ranks (ties share
    the mean position), ranks from skew-safe running counts."""
    from .windows import average_rank
    r = average_rank(df.select(*( [id_col] if id_col else []), a, b), a, out="_ra")
    r = average_rank(r, b, out="_rb")
    return r.agg(F.corr("_ra", "_rb").alias("rho"))


# ---------------------------------------------------------------- A14 many columns x many functions
_SIMPLE = {
    "mean": F.avg, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max,
    "std": F.stddev_samp, "var": F.var_samp, "nunique": F.count_distinct,
}


def multi_agg(df: DataFrame, keys, spec: dict[str, Sequence[str]], order: Sequence[str] = (),
              exact: bool = False) -> DataFrame:
    """``groupby(keys).agg({col: [fn, ...]})`` with flattened ``{col}_{fn}``
    names (A14) in one shuffle.  Functions: mean sum count min max std var
    nunique median range iqr count_pos last first (last/first need ``order``).
    The all-null-group ``sum`` is 0 as in pandas (``coalesce``).  ``exact``
    takes sums in decimal so they do not depend on row arrival order.
    """
    keys = _cols(keys)
    exprs, quant = [], []
    okey = order_key(df, order) if order else None
    for c, fns in spec.items():
        x = F.col(c)
        for fn in fns:
            name = f"{c}_{fn}"
            if fn in ("median", "iqr"):
                quant.append((c, fn))
                continue
            if fn == "sum":
                e = F.coalesce(exact_sum(x) if exact else F.sum(x), F.lit(0))
            elif fn == "mean" and exact:
                e = F.try_divide(exact_sum(x), F.count(x))
            elif fn in _SIMPLE:
                e = _SIMPLE[fn](x)
            elif fn == "range":
                e = F.max(x) - F.min(x)
            elif fn == "count_pos":
                e = F.count_if(x > 0)
            elif fn == "last":
                e = F.max_by(x, okey)
            elif fn == "first":
                e = F.min_by(x, okey)
            else:
                raise ValueError(fn)
            exprs.append(e.alias(name))
    out = df.groupBy(*keys).agg(*exprs)
    if not quant:
        return out
    q = exact_quantiles_of_columns(df, keys, list(dict.fromkeys(c for c, _ in quant)),
                                   {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75})
    cols = [(F.col(f"{c}__q2") if fn == "median" else F.col(f"{c}__q3") - F.col(f"{c}__q1")).alias(f"{c}_{fn}")
            for c, fn in quant]
    same = [out[k].eqNullSafe(F.col(f"_q_{k}")) for k in keys]
    return out.join(q.select(*[F.col(k).alias(f"_q_{k}") for k in keys], *cols), same, "left").drop(
        *[f"_q_{k}" for k in keys])


# ---------------------------------------------------------------- A5-A7, A44 order-dependent trends
def trend_features(df: DataFrame, keys, value: str, order: Sequence[str],
                   slices: int | None = None) -> DataFrame:
    """Per entity: mean period-over-period change (A5), Pearson correlation
    of value with its 0-based position (A6), first->last relative change (A7)
    and OLS slope of value on position (A44).

    Position comes from skew-safe running counts, the previous value from a
    lag inside the same ordered slices, so no entity is held in one task.
    """
    keys = _cols(keys)
    from .windows import position_and_lag
    lagged = position_and_lag(df.select(*keys, value, *order), keys, order, value, pos="_pos", prev="_prev",
                              slices=slices)
    okey = order_key(lagged, order)
    x = F.col(value)
    return lagged.groupBy(*keys).agg(
        F.avg(F.try_divide(x, F.col("_prev")) - 1).alias("avg_pct_change"),
        F.corr(x, F.col("_pos").cast("double")).alias("position_corr"),
        (F.try_divide(F.max_by(x, okey), F.min_by(x, okey)) - 1).alias("first_last_change"),
        F.regr_slope(x, F.col("_pos").cast("double")).alias("slope"),
    )


# ---------------------------------------------------------------- A16-A20, A23-A26
def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and share of total (A16); with ``by`` the share is within
    each ``by`` group (A26).  The total comes from a second aggregate joined
    on ``by`` (or a scalar subquery), not a global window."""
    by = list(by)
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))
    if by:
        tot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_tot"))
        return counts.join(tot, by).select(*by, col, "count", F.try_divide("count", "_tot").alias("share"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.select(col, "count", F.try_divide(F.col("count"), total).alias("share"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Cross-tabulation (A17, M10): ``groupBy(row).pivot(col).count()``.
    Pass ``values`` to skip the distinct-values job."""
    return df.groupBy(row).pivot(col, list(values) if values is not None else None).count().na.fill(0)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column in one pass (A23), as a long
    table (column, nulls, pct)."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "nulls")
    return long.select("column", "nulls", F.try_divide(F.col("nulls") * 100.0, F.col("_n")).alias("pct"))


def null_share_by_class(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Share of nulls per column within each target class (A24), long form."""
    wide = df.groupBy(target).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return wide.unpivot([target], list(cols), "column", "null_share")


def entity_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct entities and rows per entity."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids")) \
             .withColumn("rows_per_id", F.try_divide("n_rows", "n_ids"))


def share_of_total(df: DataFrame, keys, value: str, within: Sequence[str] = ()) -> DataFrame:
    """Sum per key divided by the grand (or ``within``-group) total."""
    keys = _cols(keys)
    s = df.groupBy(*keys).agg(F.sum(value).alias("total"))
    within = list(within)
    if within:
        t = s.groupBy(*within).agg(F.sum("total").alias("_grand"))
        return s.join(t, within).withColumn("share", F.try_divide("total", "_grand")).drop("_grand")
    grand = df.select(F.sum(value)).scalar()
    return s.withColumn("share", F.try_divide(F.col("total"), grand))


# ---------------------------------------------------------------- A27-A28 correlation
def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson matrix (A27) as a long table (a, b, corr) from one
    aggregate pass (``corr`` is a mergeable moment aggregate)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", "__")[0].alias("a"), F.split("pair", "__")[1].alias("b"), "corr")


# ---------------------------------------------------------------- A29 / A31 pivot, unpivot
def pivot_wide(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence) -> DataFrame:
    """Long -> wide (A29) with an explicit value list (no distinct job)."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "variable",
                 value: str = "value") -> DataFrame:
    """Wide -> long."""
    return df.unpivot(list(ids), list(cols), name, value)


# ---------------------------------------------------------------- A33 resample
def resample(df: DataFrame, ts: str, freq: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Calendar resample (A33).  ``freq``: 'D', 'W' (label = week-ending
    Sunday, as pandas), 'MS' (month start), 'M' (month end), 'Y'."""
    d = F.to_date(F.col(ts))
    if freq == "D":
        label = d
    elif freq == "W":
        label = F.date_add(F.date_trunc("week", d).cast("date"), 6)
    elif freq == "MS":
        label = F.trunc(d, "month")
    elif freq == "M":
        label = F.last_day(d)
    elif freq == "Y":
        label = F.trunc(d, "year")
    else:
        raise ValueError(freq)
    return df.groupBy(*keys, label.alias("period")).agg(*aggs)


# ---------------------------------------------------------------- A34-A36 profile-and-join-back
def profile_join(df: DataFrame, target: DataFrame, keys: Sequence[str], value: str, stat: str = "mean",
                 name: str | None = None) -> DataFrame:
    """Aggregate ``value`` by ``keys`` on ``df`` and left-join it to
    ``target`` (A34 calendar profile, A35 group-median forecaster, A36
    bucket means).  The profile has one row per key: Spark/AQE choose
    broadcast only when its measured size is under the threshold."""
    name = name or f"{value}_{stat}"
    if stat == "median":
        prof = grouped_quantiles(df, list(keys), value, {name: 0.5})
    else:
        fn = {"mean": lambda c: F.try_divide(exact_sum(c), F.count(c)), "sum": F.sum, "max": F.max, "min": F.min}[stat]
        prof = df.groupBy(*keys).agg(fn(value).alias(name))
    return target.join(prof, list(keys), "left")


# ---------------------------------------------------------------- A39-A40 row-wise
def row_stats(cols: Sequence[str]) -> dict[str, Column]:
    """Row-wise mean, population std, min, max over a column group (A39),
    skipping nulls like numpy nan-functions; all null where every value is."""
    arr = F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    n = F.size(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
    mean = F.try_divide(s, n)
    ss = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)
    return {
        "row_mean": mean,
        "row_std": F.when(n > 0, F.sqrt(F.greatest(F.try_divide(ss, n) - mean * mean, F.lit(0.0)))),
        "row_min": F.array_min(arr),
        "row_max": F.array_max(arr),
    }


# ---------------------------------------------------------------- A41 mode
def majority_vote(df: DataFrame, key: str, pred: str) -> DataFrame:
    """Row-wise mode of fold votes (A41/E13); ties go to the smallest value
    as ``DataFrame.mode`` does."""
    c = df.groupBy(key, pred).agg(F.count(F.lit(1)).alias("_n"))
    return c.groupBy(key).agg(F.min_by(pred, F.struct(-F.col("_n"), F.col(pred))).alias("mode"))


# ---------------------------------------------------------------- A42-A43 distributions
def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram counts (A42); values equal to ``hi`` go to the
    last bin (numpy convention)."""
    b = F.least(F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return df.where(F.col(value).between(lo, hi)).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def box_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five-number summary per class."""
    return grouped_quantiles(df, [by], value, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})
