"""Aggregate queries over the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.prefix import exact_sum
from .registry import ESUM, register


def EMEAN(x: str) -> str:
    """SQL for the order-independent mean used on the Spark side."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE) / count({x}))"


def emean(c: str):
    return exact_sum(c) / F.count(c)


# --------------------------------------------------------------------------- A14
@register("a14_multi_agg", "A14 A1 A3 A4 A15 A18",
          "o_custkey:i o_totalprice_mean:f o_totalprice_median:f o_totalprice_sum:f o_totalprice_count:i "
          "o_totalprice_min:f o_totalprice_max:f o_totalprice_std:f o_totalprice_range:f o_totalprice_iqr:f "
          "o_orderstatus_nunique:i o_orderdate_last:d",
          sql=f"""
SELECT o_custkey,
  {EMEAN('o_totalprice')} AS o_totalprice_mean, median(o_totalprice) AS o_totalprice_median,
  {ESUM('o_totalprice')} AS o_totalprice_sum, count(o_totalprice) AS o_totalprice_count,
  min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
  stddev_samp(o_totalprice) AS o_totalprice_std, max(o_totalprice) - min(o_totalprice) AS o_totalprice_range,
  quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS o_totalprice_iqr,
  count(DISTINCT o_orderstatus) AS o_orderstatus_nunique,
  CAST(arg_max(o_orderdate, (o_orderdate, o_orderkey)) AS DATE) AS o_orderdate_last
FROM orders GROUP BY o_custkey""")
def a14_multi_agg(t):
    o = t.orders
    base = A.multi_agg(o, "o_custkey", {
        "o_totalprice": ["mean", "median", "sum", "count", "min", "max", "std", "range", "iqr"],
        "o_orderstatus": ["nunique"], "o_orderdate": ["last"]}, order=["o_orderdate", "o_orderkey"], exact=True)
    return base.withColumn("o_orderdate_last", F.to_date("o_orderdate_last"))


# --------------------------------------------------------------------------- A5-A7, A44
@register("a05_trend_features", "A5 A6 A7 A44 W1 W2",
          "user_id:i avg_pct_change:f position_corr:f first_last_change:f slope:f", sql="""
WITH r AS (
  SELECT user_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
  FROM events)
SELECT user_id,
       avg(value / nullif(prev, 0) - 1) AS avg_pct_change,
       corr(value, pos) AS position_corr,
       arg_max(value, pos) / nullif(arg_min(value, pos), 0) - 1 AS first_last_change,
       regr_slope(value, pos) AS slope
FROM r GROUP BY user_id""")
def a05_trend_features(t):
    return A.trend_features(t.events, "user_id", "value", ["ts", "event_id"])


# --------------------------------------------------------------------------- A16 / A26
@register("a16_value_counts", "A16", "l_returnflag:s count:i share:f", sql="""
SELECT l_returnflag, count(*) AS count, count(*) / (SELECT count(*) FROM lineitem) AS share
FROM lineitem GROUP BY l_returnflag""")
def a16_value_counts(t):
    return A.value_counts(t.lineitem, "l_returnflag")


@register("a26_share_within_source", "A26", "o_orderstatus:s o_orderpriority:s count:i share:f", sql="""
SELECT o_orderstatus, o_orderpriority, count(*) AS count,
       count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def a26_share_within_source(t):
    return A.value_counts(t.orders, "o_orderpriority", by=["o_orderstatus"])


# --------------------------------------------------------------------------- A17 / M10
PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("a17_crosstab", "A17 M10",
          ["o_orderstatus:s"] + [f"{p}:i" for p in PRIOS],
          sql="SELECT o_orderstatus, " + ", ".join(
              f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIOS)
              + " FROM orders GROUP BY o_orderstatus")
def a17_crosstab(t):
    return A.crosstab(t.orders, "o_orderstatus", "o_orderpriority", PRIOS)


# --------------------------------------------------------------------------- A18-A20
@register("a18_entity_stats", "A18 A19 A20", "n_rows:i n_ids:i rows_per_id:f", sql="""
SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_ids,
       count(*) / count(DISTINCT o_custkey) AS rows_per_id FROM orders""")
def a18_entity_stats(t):
    return A.entity_stats(t.orders, "o_custkey")


# --------------------------------------------------------------------------- A21
@register("a21_collapse_duplicates", "A21 U3",
          "l_quantity:f l_discount:f l_returnflag:s n:i median_price:f", sql="""
SELECT l_quantity, l_discount, l_returnflag, count(*) AS n, median(l_extendedprice) AS median_price
FROM lineitem GROUP BY l_quantity, l_discount, l_returnflag""")
def a21_collapse_duplicates(t):
    return t.lineitem.groupBy("l_quantity", "l_discount", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.median("l_extendedprice").alias("median_price"))


# --------------------------------------------------------------------------- A22
_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a22_describe", "A22", "column:s count:i mean:f std:f min:f p25:f p50:f p75:f max:f",
          sql=" UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count({c}) AS count, {EMEAN(c)} AS mean, stddev_samp({c}) AS std, "
              f"min({c}) AS min, quantile_cont({c}, 0.25) AS p25, median({c}) AS p50, "
              f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM lineitem" for c in _DESC_COLS))
def a22_describe(t):
    from ..operators.quality import describe
    return describe(t.lineitem, _DESC_COLS)


# --------------------------------------------------------------------------- A23 / A24
def _customer_activity(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"),
        F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))).alias("last_pending"))
    c = t.customer
    return c.join(per, c.c_custkey == per.o_custkey, "left").drop("o_custkey")


_ACT_SQL = """(SELECT c.*, n_orders, max_price, last_pending FROM customer c LEFT JOIN (
   SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price,
          max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) AS last_pending
   FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"""
_ACT_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_orders", "max_price",
             "last_pending"]


@register("a23_null_profile", "A23 P14", "column:s nulls:i pct:f",
          sql=" UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
              f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct FROM {_ACT_SQL} a"
              for c in _ACT_COLS))
def a23_null_profile(t):
    return A.null_profile(_customer_activity(t), _ACT_COLS)


@register("a24_null_share_by_class", "A24", "c_mktsegment:s column:s null_share:f",
          sql=" UNION ALL ".join(
              f"SELECT c_mktsegment, '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) "
              f"AS null_share FROM {_ACT_SQL} a GROUP BY c_mktsegment" for c in ["n_orders", "last_pending"]))
def a24_null_share_by_class(t):
    return A.null_share_by_class(_customer_activity(t), "c_mktsegment", ["n_orders", "last_pending"])


# --------------------------------------------------------------------------- A25 / A38
@register("a25_share_of_total", "A25 A38", "l_suppkey:i total:f share:f", sql=f"""
SELECT l_suppkey, {ESUM('l_extendedprice')} AS total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE)
         / (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE) FROM lineitem) AS share
FROM lineitem GROUP BY l_suppkey""")
def a25_share_of_total(t):
    li = t.lineitem
    s = li.groupBy("l_suppkey").agg(exact_sum("l_extendedprice").alias("total"),
                                    exact_sum("l_extendedprice").alias("_t"))
    grand = li.select(exact_sum("l_extendedprice")).scalar()
    return s.select("l_suppkey", "total", (F.col("_t") / grand).alias("share"))


# --------------------------------------------------------------------------- A27
_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a27_pearson_matrix", "A27", "a:s b:s corr:f",
          sql=" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM lineitem"
                                 for i, a in enumerate(_CORR) for b in _CORR[i:]))
def a27_pearson_matrix(t):
    return A.pearson_pairs(t.lineitem, _CORR)


# --------------------------------------------------------------------------- A28
@register("a28_spearman", "A28 W14", "rho:f", sql="""
WITH r AS (
  SELECT rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0 AS rb
  FROM orders)
SELECT corr(ra, rb) AS rho FROM r""")
def a28_spearman(t):
    from ..operators.aggregates import spearman
    return spearman(t.orders, "o_totalprice", "o_custkey", id_col="o_orderkey")


# --------------------------------------------------------------------------- A29-A31
_FLAGS = ["A", "N", "R"]


@register("a29_pivot_shares", "A29 A30 A31", "year:i l_returnflag:s qty:f share:f", sql="""
WITH p AS (SELECT year(l_shipdate) AS year, l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL)
SELECT year, l_returnflag, qty, qty / sum(qty) OVER (PARTITION BY year) AS share FROM p""")
def a29_pivot_shares(t):
    li = t.lineitem.withColumn("year", F.year("l_shipdate"))
    wide = li.groupBy("year").pivot("l_returnflag", _FLAGS).agg(F.sum("l_quantity"))      # A29
    tot = sum(F.coalesce(F.col(f), F.lit(0.0)) for f in _FLAGS)
    shares = wide.select("year", *[F.col(f).alias(f"q_{f}") for f in _FLAGS],
                         *[(F.col(f) / tot).alias(f"s_{f}") for f in _FLAGS])              # A30 row-normalise
    q = A.unpivot_long(shares, ["year"], [f"q_{f}" for f in _FLAGS], "k", "qty")           # A31
    s = A.unpivot_long(shares, ["year"], [f"s_{f}" for f in _FLAGS], "k", "share")
    q = q.withColumn("l_returnflag", F.substring("k", 3, 1)).drop("k")
    s = s.withColumn("l_returnflag", F.substring("k", 3, 1)).drop("k")
    return q.join(s, ["year", "l_returnflag"]).where(F.col("qty").isNotNull())


# --------------------------------------------------------------------------- A32
@register("a32_same_day_mean", "A32 F33", "mmdd:s l_returnflag:s mean_daily_qty:f n_years:i", sql=f"""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT strftime(d, '%m-%d') AS mmdd, l_returnflag, {EMEAN('q')} AS mean_daily_qty, count(*) AS n_years
FROM d GROUP BY ALL""")
def a32_same_day_mean(t):
    d = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d"), "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return d.groupBy(F.date_format("d", "MM-dd").alias("mmdd"), "l_returnflag").agg(
        emean("q").alias("mean_daily_qty"), F.count(F.lit(1)).alias("n_years"))


# --------------------------------------------------------------------------- A33
@register("a33_resample_weekly", "A33", "event_type:s period:d n:i value_sum:f", sql=f"""
SELECT event_type, CAST(date_trunc('week', ts) AS DATE) + 6 AS period, count(*) AS n, {ESUM('value')} AS value_sum
FROM events GROUP BY ALL""")
def a33_resample_weekly(t):
    return A.resample(t.events, "ts", "W", ["event_type"], [F.count(F.lit(1)).alias("n"),
                                                            exact_sum("value").alias("value_sum")])


@register("a33_resample_monthly", "A33", "period:d n:i price_sum:f", sql=f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n, {ESUM('o_totalprice')} AS price_sum
FROM orders GROUP BY ALL""")
def a33_resample_monthly(t):
    return A.resample(t.orders, "o_orderdate", "MS", [], [F.count(F.lit(1)).alias("n"),
                                                          exact_sum("o_totalprice").alias("price_sum")])


# --------------------------------------------------------------------------- A34-A36
@register("a34_profile_join", "A34 J1", "o_orderkey:i profile_mean:f", sql=f"""
WITH p AS (SELECT o_orderpriority, month(o_orderdate) AS m, {EMEAN('o_totalprice')} AS profile_mean
           FROM orders WHERE year(o_orderdate) < 2000 GROUP BY ALL)
SELECT o.o_orderkey, p.profile_mean FROM orders o
LEFT JOIN p ON o.o_orderpriority = p.o_orderpriority AND month(o.o_orderdate) = p.m
WHERE year(o.o_orderdate) >= 2000""")
def a34_profile_join(t):
    o = t.orders.withColumn("m", F.month("o_orderdate"))
    hist = o.where(F.year("o_orderdate") < 2000)
    fut = o.where(F.year("o_orderdate") >= 2000)
    prof = hist.groupBy("o_orderpriority", "m").agg(emean("o_totalprice").alias("profile_mean"))
    return fut.join(prof, ["o_orderpriority", "m"], "left").select("o_orderkey", "profile_mean")


@register("a35_group_median_forecast", "A35 E12", "o_orderkey:i forecast:f", sql="""
WITH p AS (SELECT o_orderstatus, o_orderpriority, median(o_totalprice) AS med
           FROM orders WHERE year(o_orderdate) < 2000 GROUP BY ALL)
SELECT o.o_orderkey, CASE WHEN o.o_orderstatus = 'P' THEN p.med + 98 ELSE p.med END AS forecast
FROM orders o LEFT JOIN p USING (o_orderstatus, o_orderpriority)
WHERE year(o.o_orderdate) >= 2000""")
def a35_group_median_forecast(t):
    o = t.orders
    hist, fut = o.where(F.year("o_orderdate") < 2000), o.where(F.year("o_orderdate") >= 2000)
    j = A.profile_join(hist, fut, ["o_orderstatus", "o_orderpriority"], "o_totalprice", "median", "med")
    return j.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("med") + 98)
                    .otherwise(F.col("med")).alias("forecast"))


@register("a36_bucket_mean", "A36", "o_orderkey:i bucket:i bucket_mean_price:f", sql=f"""
WITH b AS (SELECT o_orderkey, CAST(floor(o_totalprice / 50000) AS BIGINT) AS bucket, o_totalprice FROM orders),
p AS (SELECT bucket, {EMEAN('o_totalprice')} AS bucket_mean_price FROM b GROUP BY bucket)
SELECT o_orderkey, bucket, bucket_mean_price FROM b JOIN p USING (bucket)""")
def a36_bucket_mean(t):
    o = t.orders.withColumn("bucket", F.floor(F.col("o_totalprice") / 50000).cast("long"))
    prof = o.groupBy("bucket").agg(emean("o_totalprice").alias("bucket_mean_price"))
    return o.join(prof, "bucket").select("o_orderkey", "bucket", "bucket_mean_price")


# --------------------------------------------------------------------------- A37 / M17
@register("a37_two_level_having", "A37", "o_custkey:i miss_rate:f", sql="""
WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, count(*) AS n,
                  arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price,
                  avg(o_totalprice) AS mean_price FROM orders GROUP BY ALL)
SELECT o_custkey, avg(CASE WHEN last_price > mean_price THEN 1.0 ELSE 0.0 END) AS miss_rate
FROM y GROUP BY o_custkey HAVING avg(CASE WHEN last_price > mean_price THEN 1.0 ELSE 0.0 END) >= 0.5""")
def a37_two_level_having(t):
    o = t.orders.withColumn("yr", F.year("o_orderdate"))
    y = o.groupBy("o_custkey", "yr").agg(
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_price"),
        F.avg("o_totalprice").alias("mean_price"))
    flag = F.when(F.col("last_price") > F.col("mean_price"), 1.0).otherwise(0.0)
    return y.groupBy("o_custkey").agg(F.avg(flag).alias("miss_rate")).where(F.col("miss_rate") >= 0.5)


# --------------------------------------------------------------------------- A39-A40
@register("a39_row_stats", "A39 F42", "o_orderkey:i row_mean:f row_std:f row_min:f row_max:f", sql="""
WITH r AS (SELECT o_orderkey, list_filter([o_totalprice / 1000, CAST(o_custkey AS DOUBLE),
                                           CAST(month(o_orderdate) AS DOUBLE)], lambda x: x IS NOT NULL) AS a FROM orders)
SELECT o_orderkey, list_avg(a) AS row_mean,
       sqrt(greatest(list_aggregate(list_transform(a, lambda x: x * x), 'sum') / len(a) - list_avg(a) * list_avg(a), 0))
         AS row_std,
       list_min(a) AS row_min, list_max(a) AS row_max FROM r""")
def a39_row_stats(t):
    o = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("a"),
                        F.col("o_custkey").cast("double").alias("b"),
                        F.month("o_orderdate").cast("double").alias("c"))
    st = A.row_stats(["a", "b", "c"])
    return o.select("o_orderkey", *[e.alias(k) for k, e in st.items()])


@register("a40_block_iqr", "A40", "iqr:f", sql="""
SELECT quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM (
  SELECT l_quantity AS v FROM lineitem UNION ALL SELECT l_discount * 100 FROM lineitem
  UNION ALL SELECT l_tax * 100 FROM lineitem)""")
def a40_block_iqr(t):
    li = t.lineitem.select("l_quantity", (F.col("l_discount") * 100).alias("d"), (F.col("l_tax") * 100).alias("x"))
    return A.block_iqr(li, ["l_quantity", "d", "x"])


# --------------------------------------------------------------------------- A41
@register("a41_mode_vote", "A41 E13", "user_id:i mode:s", sql="""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, arg_min(event_type, (-n, event_type)) AS mode FROM c GROUP BY user_id""")
def a41_mode_vote(t):
    return A.majority_vote(t.events, "user_id", "event_type")


# --------------------------------------------------------------------------- A42-A43
@register("a42_histogram", "A42", "bin:i count:i", sql="""
SELECT least(CAST(floor(value / 10.0) AS BIGINT) + 1, 50) AS bin, count(*) AS count
FROM events WHERE value BETWEEN 0 AND 500 GROUP BY ALL""")
def a42_histogram(t):
    return A.histogram(t.events, "value", 0.0, 500.0, 50)


@register("a43_box_summary", "A43", "event_type:s min:f q1:f median:f q3:f max:f", sql="""
SELECT event_type, min(value) AS min, quantile_cont(value, 0.25) AS q1, median(value) AS median,
       quantile_cont(value, 0.75) AS q3, max(value) AS max FROM events GROUP BY event_type""")
def a43_box_summary(t):
    return A.box_summary(t.events, "event_type", "value")
