"""Window queries: per-customer order series and global
orders over ``events``."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.prefix import exact_sum
from .registry import ESUM, register

K, O = ["o_custkey"], ["o_orderdate", "o_orderkey"]
WIN = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


@register("w01_lag_features", "W1 W2 W3 W4 W5 W17",
          "o_orderkey:i pos:i lag1:f lag2:f diff1:f pct_change:f target:f", sql=f"""
SELECT o_orderkey, row_number() OVER ({WIN}) - 1 AS pos,
       lag(o_totalprice, 1) OVER ({WIN}) AS lag1, lag(o_totalprice, 2) OVER ({WIN}) AS lag2,
       o_totalprice - lag(o_totalprice, 1) OVER ({WIN}) AS diff1,
       o_totalprice / nullif(lag(o_totalprice, 1) OVER ({WIN}), 0) - 1 AS pct_change,
       lead(o_totalprice) OVER ({WIN}) / nullif(o_totalprice, 0) - 1 AS target
FROM orders""")
def w01_lag_features(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    f = W.series_features(o, K, O, "o_totalprice", lags=[1, 2], leads=[1], pct_change=True, position=True,
                          prefix="")
    return f.select("o_orderkey", "pos", "lag1", "lag2", (F.col("o_totalprice") - F.col("lag1")).alias("diff1"),
                    "pct_change", (F.try_divide(F.col("lead1"), F.col("o_totalprice")) - 1).alias("target"))


@register("w06_rolling_sums", "W6", "o_orderkey:i roll2:f roll4:f roll6:f", sql=f"""
SELECT o_orderkey,
  sum(o_totalprice) OVER ({WIN} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS roll2,
  sum(o_totalprice) OVER ({WIN} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS roll4,
  sum(o_totalprice) OVER ({WIN} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS roll6
FROM orders""")
def w06_rolling_sums(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return W.series_features(o, K, O, "o_totalprice", rolling=[2, 4, 6], prefix="").select(
        "o_orderkey", "roll2", "roll4", "roll6")


_HOLE = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"


@register("w07_fills", "W7 W8 W9 X10", "o_orderkey:i missing:i ffill:f bfill:f group_last:f", sql=f"""
WITH h AS (SELECT *, {_HOLE} AS v FROM orders)
SELECT o_orderkey, CAST(v IS NULL AS INTEGER) AS missing,
  last(v IGNORE NULLS) OVER ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffill,
  first(v IGNORE NULLS) OVER ({WIN} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bfill,
  last(v IGNORE NULLS) OVER ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS group_last
FROM h""")
def w07_fills(t):
    h = t.orders.select("o_orderkey", "o_custkey", "o_orderdate",
                        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("v"))
    f = W.series_features(h, K, O, "v", ffill=True, bfill=True, group_last=True, prefix="")
    return f.select("o_orderkey", F.col("v").isNull().cast("int").alias("missing"), "ffill", "bfill",
                    F.col("last").alias("group_last"))


@register("w10_value_at_period", "W10 W11", "o_orderkey:i value_at_2:f guarded_change:f", sql=f"""
WITH p AS (SELECT *, row_number() OVER ({WIN}) - 1 AS pos,
                  lag(o_totalprice) OVER ({WIN}) AS prev FROM orders)
SELECT o_orderkey, max(CASE WHEN pos = 2 THEN o_totalprice END) OVER (PARTITION BY o_custkey) AS value_at_2,
  abs(CASE WHEN prev = 0 AND o_totalprice > 0 THEN 1.0 WHEN prev = 0 THEN 0.0
           ELSE greatest(coalesce(o_totalprice / prev, 1.0), 0.0) - 1 END) AS guarded_change
FROM p""")
def w10_value_at_period(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    p = W.series_features(o, K, O, "o_totalprice", lags=[1], position=True, prefix="")
    # value at a fixed period: an aggregate per customer joined back (partial aggregation, no window)
    at2 = p.groupBy("o_custkey").agg(F.max(F.when(F.col("pos") == 2, F.col("o_totalprice"))).alias("value_at_2"))
    return p.join(at2, "o_custkey").select(
        "o_orderkey", "value_at_2", W.guarded_change(F.col("o_totalprice"), F.col("lag1")).alias("guarded_change"))


_MONTHLY_SQL = f"""SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                         {ESUM('o_totalprice')} / 1000 AS v FROM orders GROUP BY ALL"""


@register("w12_level_shift", "W12", "o_custkey:i month:d v:f repaired:f", sql=f"""
WITH m AS ({_MONTHLY_SQL}),
p AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY o_custkey) AS n,
             lag(v) OVER w AS prev,
             avg(v) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb
      FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY month)),
f AS (SELECT *, CASE WHEN pos >= 3 AND pos <= least(37, n - 1) AND abs(v - prev) >= 0.2 * mb
                     THEN ln(v / prev) ELSE 0.0 END AS lr FROM p),
g AS (SELECT *, v * exp(coalesce(sum(lr) OVER (PARTITION BY o_custkey ORDER BY month
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0.0)) AS vv FROM f)
SELECT o_custkey, month, v,
  CASE WHEN pos = 0 AND n > 1 THEN lead(vv) OVER (PARTITION BY o_custkey ORDER BY month) * 0.99
       ELSE vv END AS repaired
FROM g""")
def w12_level_shift(t):
    m = t.orders.groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        (exact_sum("o_totalprice") / 1000).alias("v"))                  # monthly sales in thousands
    return W.level_shift_repair(m, "o_custkey", ["month"], "v", "repaired")


@register("w13_cumsum_desc", "W13 O1", "event_id:i cum_value:f cum_n:i", sql="""
SELECT event_id,
  sum(value) OVER (ORDER BY value DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_value,
  row_number() OVER (ORDER BY value DESC, event_id) AS cum_n
FROM events""")
def w13_cumsum_desc(t):
    e = t.events.select("event_id", "value", F.lit(1).alias("n"))
    return W.cumulative_desc(e, "value", "event_id", ["value", "n"]).select(
        "event_id", F.col("cum_value"), F.col("cum_n"))


@register("w14_average_rank", "W14", "event_id:i rank:f", sql="""
SELECT event_id, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rank
FROM events""")
def w14_average_rank(t):
    return W.average_rank(t.events.select("event_id", "value"), "value").select("event_id", "rank")


@register("w15_zscore_outliers", "W15 W16", "event_id:i z:f is_outlier:i scaled:f", sql="""
SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z,
  CAST(abs((value - avg(value) OVER ()) / stddev_pop(value) OVER ()) > 3 AS INTEGER) AS is_outlier,
  (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS scaled
FROM events""")
def w15_zscore_outliers(t):
    e = t.events
    z = W.zscore(e, "value")
    return e.select("event_id", z.alias("z"), (F.abs(z) > 3).cast("int").alias("is_outlier"),
                    W.minmax_rescale(e, "value").alias("scaled"))


@register("w18_head_tail", "W18 O2", "o_orderkey:i part:s", sql=f"""
SELECT o_orderkey, 'head' AS part FROM (SELECT o_orderkey, row_number() OVER ({WIN}) AS rn FROM orders) WHERE rn <= 2
UNION ALL
SELECT o_orderkey, 'tail' FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 2""")
def w18_head_tail(t):
    o = t.orders
    h = W.head_tail_by_group(o, K, O, 2).select("o_orderkey", F.lit("head").alias("part"))
    tl = W.head_tail_by_group(o, K, O, 2, tail=True).select("o_orderkey", F.lit("tail").alias("part"))
    return h.unionByName(tl)


@register("w19_error_by_period", "W19", "pos:i err_sum:f", sql=f"""
SELECT pos, {ESUM('err')} AS err_sum FROM (
  SELECT row_number() OVER ({WIN}) - 1 AS pos,
         abs(o_totalprice - lag(o_totalprice) OVER ({WIN})) AS err FROM orders)
WHERE err IS NOT NULL GROUP BY pos""")
def w19_error_by_period(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    p = W.series_features(o, K, O, "o_totalprice", lags=[1], position=True, prefix="")
    e = p.select("pos", F.abs(F.col("o_totalprice") - F.col("lag1")).alias("err"))
    return W.error_by_period(e.where(F.col("err").isNotNull()), "pos", "err", exact=True)
