"""Window operators.

Per-entity windows (``partitionBy(entity).orderBy(time)``) are used where a
partition is one entity's time series (county-month, customer-statement,
store-day): its length is the number of periods, not a share of the table.
Where a group can be a large share of all rows — global orders (W13, W14),
positions and lag-1 over event streams — the skew-safe two-level helpers
from ``prefix`` are used instead.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import range_slices, running_sums


def _w(keys, order):
    return Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])


# ---------------------------------------------------------------- W1-W5
def position(keys, order) -> Column:
    """0-based position in group (W1, ``cumcount``)."""
    return F.row_number().over(_w(keys, order)) - 1


def lag(col: str, n: int, keys, order) -> Column:
    """``groupby(k)[c].shift(n)`` (W2); negative ``n`` is a lead."""
    return F.lag(col, n).over(_w(keys, order)) if n >= 0 else F.lead(col, -n).over(_w(keys, order))


def diff(col: str, n: int, keys, order) -> Column:
    """``groupby(k)[c].diff(n)``."""
    return F.col(col) - F.lag(col, n).over(_w(keys, order))


def pct_change(df: DataFrame, col: str, keys, order, out: str, n: int = 1) -> DataFrame:
    """``groupby(k)[c].pct_change()`` (W5): nulls are padded forward first
    (pandas default); division by zero gives null instead of inf."""
    w = _w(keys, order)
    tmp = f"_pad_{col}"
    df = df.withColumn(tmp, F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn(out, F.try_divide(F.col(tmp), F.lag(tmp, n).over(w)) - 1).drop(tmp)


def target_ratio(col: str, keys, order) -> Column:
    """Next-period relative change used as target (W3): ``lead(c)/c - 1``."""
    return F.try_divide(F.lead(col).over(_w(keys, order)), F.col(col)) - 1


# ---------------------------------------------------------------- W6-W10
def rolling_sum(col: str, window: int, keys, order) -> Column:
    """``rolling(window, min_periods=1).sum()``."""
    return F.sum(col).over(_w(keys, order).rowsBetween(-(window - 1), 0))


def rolling_mean(col: str, window: int, keys, order) -> Column:
    return F.avg(col).over(_w(keys, order).rowsBetween(-(window - 1), 0))


def ffill(col: str, keys, order) -> Column:
    """Forward fill within group."""
    return F.last(col, ignorenulls=True).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))


def bfill(col: str, keys, order) -> Column:
    """Back fill within group."""
    return F.first(col, ignorenulls=True).over(_w(keys, order).rowsBetween(0, Window.unboundedFollowing))


def group_last(col: str, keys, order) -> Column:
    """``transform('last')`` (W9): last non-null value, on every row."""
    return F.last(col, ignorenulls=True).over(
        _w(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def value_at(col: str, keys, cond: Column) -> Column:
    """Value at a fixed period broadcast to the entity."""
    return F.max(F.when(cond, F.col(col))).over(Window.partitionBy(*keys))


def guarded_change(cur: Column, prev: Column) -> Column:
    """Guarded absolute relative change (W11): ratio filled with 1, clipped
    at 0, minus 1; 0 when the previous value is 0, 1 when it grows from 0."""
    base = F.greatest(F.coalesce(F.try_divide(cur, prev), F.lit(1.0)), F.lit(0.0)) - 1
    v = F.when((prev == 0) & (cur > 0), F.lit(1.0)).when(prev == 0, F.lit(0.0)).otherwise(base)
    return F.abs(v)


# ---------------------------------------------------------------- W12 level-shift repair
def level_shift_repair(df: DataFrame, keys, order, value: str, out: str,
                       first_i: int = 37, last_i: int = 3, frac: float = 0.20) -> DataFrame:
    """Level-shift (outlier) back-adjustment.

    The reference walks i = first_i .. last_i downwards and, when
    |v[i]-v[i-1]| >= frac * mean(v[:i]), rescales v[:i] by v[i]/v[i-1]; then
    sets v[0] = 0.99 v[1].  Only the first ``first_i`` + 1 rows of a series
    take part, however long it is: they are cut off before the shuffle (a
    limit per group), walked as one array per series by a fold over i, and
    put back; all other rows keep their value.  No series is in one task.

    ``order`` is total within a series.  A step from 0 gives an infinite or
    undefined ratio, as in floating point; a step from or to a null is none.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    cols = df.columns
    head = df.withColumn("_rn", F.row_number().over(_w(keys, order))).where(F.col("_rn") <= first_i + 1)
    series = head.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        "_rn", F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row")))).alias("_rows"))
    v0 = F.transform("_rows", lambda r: r["row"][value].cast("double"))

    def ratio(a: Column, b: Column) -> Column:
        zero = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
        return F.when(b == 0, zero).otherwise(F.try_divide(a, b))

    def rescale(v: Column, i: Column) -> Column:
        before = F.filter(F.slice(v, F.lit(1), i), lambda x: x.isNotNull())
        mean = F.try_divide(F.aggregate(before, F.lit(0.0), lambda s, x: s + x), F.size(before))
        cur, prev = F.get(v, i), F.get(v, i - 1)
        step = F.abs(cur - prev)
        shift = (step >= F.lit(frac) * mean) & ~F.isnan(step) & ~F.isnan(mean)
        return F.when(shift, F.transform(v, lambda x, j: F.when(j < i, x * ratio(cur, prev)).otherwise(x))).otherwise(v)
    top = F.least(F.lit(first_i), F.size("_rows") - 1)
    walk = F.when(top >= last_i, F.sequence(top, F.lit(last_i), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    walked = series.select("_rows", F.aggregate(walk, v0, rescale).alias("_v"))
    fixed = F.when(F.size("_v") > 1, F.concat(F.array(F.col("_v")[1] * 0.99), F.slice("_v", F.lit(2), F.size("_v")))).otherwise(
        F.col("_v"))
    done = walked.select("_rows", fixed.alias("_v")).select(F.explode(F.arrays_zip("_rows", "_v")).alias("_x"))
    done = done.select(*[F.col("_x._rows.row").getField(c).alias(c) for c in cols], F.col("_x._v").alias(out))
    ids = head.select(*[F.col(f"`{c}`").alias(f"_h{k}") for k, c in enumerate([*keys, *order])])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_h{k}")) for k, c in enumerate([*keys, *order])])
    tail = df.join(ids, same, "left_anti").withColumn(out, F.col(f"`{value}`").cast("double"))
    return done.unionByName(tail.select(*done.columns))


# ---------------------------------------------------------------- W13-W16 global order / scale
def cumulative_desc(df: DataFrame, score: str, tie: str, values: Sequence[str],
                    slices: int | None = None) -> DataFrame:
    """Cumulative sums of ``values`` by descending score (W13), ties broken
    by ``tie``; two-level range-partitioned prefix sum, never one task."""
    return running_sums(df, [(score, "desc"), tie], list(values), slices=slices)


def average_rank(df: DataFrame, score: str, out: str = "rank", groups: Sequence[str] = (),
                 slices: int | None = None) -> DataFrame:
    """1-based average rank of ``score`` (W14, ``rankdata``): ties share the
    mean of their positions.  Distinct scores are counted first so a hot
    score value is one row, then ranked with skew-safe running counts."""
    groups = list(groups)
    counts = df.groupBy(*groups, score).agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(counts, [score], ["_n"], groups=groups, slices=slices)
    ranks = cum.select(*groups, score, (F.col("cum__n") - (F.col("_n") - 1) / 2.0).alias(out))
    return df.join(ranks, [*groups, score], "left")


def zscore(df: DataFrame, col: str) -> Column:
    """(x - mean) / population std (W15, ``scipy.stats.zscore``); the two
    statistics are scalar subqueries, not a global window.  Null where the
    column is constant."""
    st = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_pop(col).alias("s"))).scalar()   # one aggregate pass
    return F.try_divide(F.col(col) - st.getField("m"), st.getField("s"))


def minmax_rescale(df: DataFrame, col: str) -> Column:
    """(x - min) / (max - min) over the whole column (W16), null where it is
    constant."""
    st = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    return F.try_divide(F.col(col) - st.getField("lo"), st.getField("hi") - st.getField("lo"))


# ---------------------------------------------------------------- W18-W19
def head_tail_by_group(df: DataFrame, keys, order, k: int, tail: bool = False) -> DataFrame:
    """First-k (or last-k) rows of every group by order."""
    o = [F.desc(c) if tail else F.asc(c) for c in order]
    w = Window.partitionBy(*keys).orderBy(*o)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def error_by_period(df: DataFrame, period: str, err: str, exact: bool = False) -> DataFrame:
    """Sum of an error column per period (W19); ``exact`` sums in decimal
    (independent of row order)."""
    from .prefix import exact_sum
    return df.groupBy(period).agg((exact_sum(err) if exact else F.sum(err)).alias(f"{err}_sum"))


# ---------------------------------------------------------------- skew-safe lag 1
def lag_skew_safe(df: DataFrame, keys, order: Sequence[str], value: str, out: str,
                  slices: int | None = None) -> DataFrame:
    """Previous row's ``value`` within ``keys`` by ``order`` without placing
    a group in one task: range slices on (keys, order), local lag, and the
    first row of each (slice, group) takes the last value of the group's
    previous slice from a one-row-per-(slice, group) table."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    ranged, field, order_cols, gk = range_slices(df, keys, order, slices)
    part = ["_slice", *gk]
    w = Window.partitionBy(*part).orderBy(*order_cols)
    loc = ranged.select(*part, "_row", F.lag(field(value)).over(w).alias("_lag"),
                        F.row_number().over(w).alias("_rn"))
    edge = ranged.groupBy(*part).agg(
        F.count("_row").alias("_rows"),
        F.max_by(field(value), F.struct(*[field(o) for o in order])).alias("_lastv"))
    prev = edge.select(*part, F.lag("_lastv").over(Window.partitionBy(*gk).orderBy("_slice")).alias("_pv"))
    res = loc.join(prev, part, "left")
    return res.select(*[field(c).alias(c) for c in cols],
                      F.when(F.col("_rn") == 1, F.col("_pv")).otherwise(F.col("_lag")).alias(out))


def position_and_lag(df: DataFrame, keys, order: Sequence[str], value: str, pos: str = "pos",
                     prev: str = "prev", slices: int | None = None) -> DataFrame:
    """0-based position and previous ``value`` within ``keys`` by ``order``
    from one range-sliced pass (W1 + W2 for hot groups): local row number
    and lag per (slice, group), plus, from a one-row-per-(slice, group)
    table, the rows in earlier slices of the group and the last value of
    its previous slice."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    ranged, field, order_cols, gk = range_slices(df, keys, order, slices)
    part = ["_slice", *gk]
    w = Window.partitionBy(*part).orderBy(*order_cols)
    loc = ranged.select(*part, "_row", F.lag(field(value)).over(w).alias("_lag"),
                        F.row_number().over(w).alias("_rn"))
    edge = ranged.groupBy(*part).agg(
        F.count("_row").alias("_cnt"),
        F.max_by(field(value), F.struct(*[field(o) for o in order])).alias("_lastv"))
    ws = Window.partitionBy(*gk).orderBy("_slice")
    offs = edge.select(*part,
                       F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                       .alias("_off"), F.lag("_lastv").over(ws).alias("_pv"))
    res = loc.join(offs, part, "left")
    return res.select(*[field(c).alias(c) for c in cols],
                      (F.col("_rn") - 1 + F.col("_off")).alias(pos),
                      F.when(F.col("_rn") == 1, F.col("_pv")).otherwise(F.col("_lag")).alias(prev))


def series_features(df: DataFrame, keys, order: Sequence[str], value: str, lags: Sequence[int] = (),
                    leads: Sequence[int] = (), rolling: Sequence[int] = (), ffill: bool = False,
                    bfill: bool = False, group_last: bool = False, pct_change: bool = False,
                    position: bool = False, slices: int | None = None, prefix: str | None = None) -> DataFrame:
    """Per-series lags (W2), leads (W3), differences (W4), padded
    pct_change (W5), rolling sums with min_periods=1 (W6), forward / back
    fills (W7, W8) and the group's last non-null value (W9) in one
    range-sliced pass, so no series is held in one task however long it is.

    Inside each (slice, group) ordinary windows do the work; values that
    cross a slice boundary come from a one-row-per-(slice, group) table
    holding the slice's last n values (n = max lag / rolling width - 1), its
    first n values (n = max lead) and its last / first non-null value, carried
    across slices by windows over that small table.  Output columns are
    ``{p}lag{k}``, ``{p}lead{k}``, ``{p}roll{w}``, ``{p}ffill``,
    ``{p}bfill``, ``{p}last``, ``{p}pct_change`` with ``p = value + '_'``,
    and ``pos`` (0-based position in the series, W1) when ``position``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    p = prefix if prefix is not None else f"{value}_"
    cols = df.columns
    ranged, field, order_cols, gk = range_slices(df, keys, order, slices)
    part = ["_slice", *gk]
    v = field(value)
    okey = F.struct(*[field(o) for o in order])
    n_tail = max([*lags, *[w - 1 for w in rolling], 1 if pct_change else 0, 0])
    n_head = max([*leads, 0])
    w = Window.partitionBy(*part).orderBy(*order_cols)
    exprs = [F.row_number().over(w).alias("_rn"), F.count("_row").over(Window.partitionBy(*part)).alias("_cnt")]
    exprs += [F.lag(v, k).over(w).alias(f"_lag{k}") for k in lags]
    exprs += [F.lead(v, k).over(w).alias(f"_lead{k}") for k in leads]
    exprs += [F.sum(v).over(w.rowsBetween(-(r - 1), 0)).alias(f"_roll{r}") for r in rolling]
    if ffill or pct_change:
        exprs.append(F.last(v, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_ff"))
    if pct_change:
        exprs.append(F.last(v, True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_ffp"))
    if bfill:
        exprs.append(F.first(v, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("_bf"))
    loc = ranged.select(*part, "_row", *exprs)

    # one row per (slice, group): boundary values of the slice (bounded arrays)
    ends = loc.groupBy(*part).agg(
        F.count("_row").alias("_rows"),
        F.max_by(field(value), F.when(field(value).isNotNull(), okey)).alias("_lnn"),
        F.min_by(field(value), F.when(field(value).isNotNull(), okey)).alias("_fnn"),
        F.sort_array(F.collect_list(F.when(F.col("_rn") > F.col("_cnt") - n_tail, F.struct("_rn", field(value).alias("v")))))
        .alias("_tail"),
        F.sort_array(F.collect_list(F.when(F.col("_rn") <= n_head, F.struct("_rn", field(value).alias("v")))))
        .alias("_head"))
    ws = Window.partitionBy(*gk).orderBy("_slice")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    after = ws.rowsBetween(1, Window.unboundedFollowing)
    prev_all = F.flatten(F.collect_list(F.transform("_tail", lambda s: s["v"])).over(before))
    next_all = F.flatten(F.collect_list(F.transform("_head", lambda s: s["v"])).over(after))
    carry = ends.select(
        *part,
        F.slice(prev_all, F.greatest(F.size(prev_all) - n_tail + 1, F.lit(1)), n_tail).alias("_prev")
        if n_tail else F.lit(None).alias("_prev"),
        F.slice(next_all, 1, n_head).alias("_next") if n_head else F.lit(None).alias("_next"),
        F.last("_lnn", True).over(before).alias("_cff"),
        F.first("_fnn", True).over(after).alias("_cbf"),
        F.last("_lnn", True).over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_glast"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    j = loc.join(carry, part, "left")

    rn, cnt, prev, nxt = F.col("_rn"), F.col("_cnt").cast("int"), F.col("_prev"), F.col("_next")
    out = [field(c).alias(c) for c in cols]
    if position:
        out.append((rn - 1 + F.col("_off")).alias("pos"))
    for k in lags:
        out.append(F.when(rn > k, F.col(f"_lag{k}"))
                   .otherwise(F.try_element_at(prev, (-(F.lit(k) - rn + 1)).cast("int"))).alias(f"{p}lag{k}"))
    for k in leads:
        out.append(F.when(rn + k <= cnt, F.col(f"_lead{k}"))
                   .otherwise(F.try_element_at(nxt, (rn + k - cnt).cast("int"))).alias(f"{p}lead{k}"))
    for r in rolling:
        m = F.greatest(F.lit(r) - rn, F.lit(0))                       # values needed from earlier slices
        take = F.slice(F.coalesce(prev, F.array().cast("array<double>")),
                       F.greatest(F.size(F.coalesce(prev, F.array())) - m + 1, F.lit(1)),
                       F.least(m, F.size(F.coalesce(prev, F.array()))))
        vals = F.filter(take, lambda x: x.isNotNull())
        ps = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x)
        loc_sum = F.col(f"_roll{r}")
        out.append(F.when(loc_sum.isNull() & (F.size(vals) == 0), F.lit(None))
                   .otherwise(F.coalesce(loc_sum, F.lit(0.0)) + ps).alias(f"{p}roll{r}"))
    if ffill:
        out.append(F.coalesce(F.col("_ff"), F.col("_cff")).alias(f"{p}ffill"))
    if bfill:
        out.append(F.coalesce(F.col("_bf"), F.col("_cbf")).alias(f"{p}bfill"))
    if group_last:
        out.append(F.col("_glast").alias(f"{p}last"))
    if pct_change:
        pad = F.coalesce(F.col("_ff"), F.col("_cff"))
        ppad = F.coalesce(F.col("_ffp"), F.col("_cff"))
        out.append((F.try_divide(pad, ppad) - 1).alias(f"{p}pct_change"))
    return j.select(*out)
