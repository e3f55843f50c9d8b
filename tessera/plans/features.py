"""Calendar (F20-F34) and projection / predicate (P1-P34, F35) queries."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import columns as P
from ..operators.prefix import exact_sum
from .registry import ESUM, register


@register("c20_calendar_parts", "F20 F21 F22 F23 F24 F33 F34",
          "event_id:i year:i month:i day:i dayofyear:i quarter:i hour:i minute:i weekday:i month_name:s "
          "weekend:i weekday_group:i mmdd:s days_in_month:i parsed:d", sql="""
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, dayofyear(ts) AS dayofyear,
  quarter(ts) AS quarter, hour(ts) AS hour, minute(ts) AS minute, isodow(ts) - 1 AS weekday,
  monthname(ts) AS month_name, CAST(isodow(ts) >= 6 AS INTEGER) AS weekend,
  CASE WHEN isodow(ts) <= 4 THEN 0 WHEN isodow(ts) = 5 THEN 1 WHEN isodow(ts) = 6 THEN 2 ELSE 3 END AS weekday_group,
  strftime(ts, '%m-%d') AS mmdd, day(last_day(ts)) AS days_in_month,
  strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y')::DATE AS parsed
FROM events""")
def c20_calendar_parts(t):
    e = t.events
    parts = C.date_parts("ts")
    return e.select("event_id", *[v.alias(k) for k, v in parts.items()],
                    C.parse_date(F.date_format("ts", "dd.MM.yyyy"), "dd.MM.yyyy").alias("parsed"))


@register("c25_cyclic_encoding", "F25 F26 F27 F28",
          "o_orderkey:i month_sin:f month_cos:f sin1:f cos1:f sin2:f cos2:f urgent_sin1:f doy_aligned:i important:i",
          sql=f"""
WITH d AS (SELECT o_orderkey, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS d, o_orderpriority FROM orders)
SELECT o_orderkey, sin(month(ts) * {2 * math.pi / 12}) AS month_sin, cos(month(ts) * {2 * math.pi / 12}) AS month_cos,
  sin(dayofyear(ts) * 1 * {2 * math.pi / 365.0}) AS sin1, cos(dayofyear(ts) * 1 * {2 * math.pi / 365.0}) AS cos1,
  sin(dayofyear(ts) * 2 * {2 * math.pi / 365.0}) AS sin2, cos(dayofyear(ts) * 2 * {2 * math.pi / 365.0}) AS cos2,
  sin(dayofyear(ts) * 1 * {2 * math.pi / 365.0}) * CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent_sin1,
  CASE WHEN day(last_day(make_date(year(d), 2, 1))) = 29 AND month(d) > 2 THEN dayofyear(d) - 1
       ELSE dayofyear(d) END AS doy_aligned,
  CASE WHEN strftime(d, '%m-%d') IN ('12-25', '01-01', '07-04') THEN dayofyear(d) ELSE 0 END AS important
FROM d""")
def c25_cyclic_encoding(t):
    o = t.orders
    ms, mc = C.cyclic(F.month("o_orderdate"), 12)
    fo = C.fourier_terms(F.dayofyear("o_orderdate"), 2)
    urgent = (F.col("o_orderpriority") == "1-URGENT").cast("int")
    return o.select("o_orderkey", ms.alias("month_sin"), mc.alias("month_cos"),
                    *[v.alias(k) for k, v in fo.items()], (fo["sin1"] * urgent).alias("urgent_sin1"),
                    C.leap_aligned_doy("o_orderdate").alias("doy_aligned"),
                    C.keep_if_important("o_orderdate", ["12-25", "01-01", "07-04"]).alias("important"))


_EASTER_SQL = """make_date(y, ((h + l - 7 * m + 114) // 31), ((h + l - 7 * m + 114) % 31) + 1)"""
_COMPUTUS = """(SELECT y, a, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM (
      SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
        SELECT y, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
          SELECT y, y % 19 AS a, y // 100 AS b, (y // 100) // 4 AS d, (y // 100) % 4 AS e,
                 ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 AS g, (y % 100) // 4 AS i, (y % 100) % 4 AS k
          FROM yrs))))"""


@register("c29_easter_and_anchors", "F29 F30 F31",
          "o_orderkey:i easter:d easter_offset:i easter_window:i xmas_week:i last_wed_june:d first_sun_nov:d",
          sql=f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
yrs AS (SELECT DISTINCT y FROM o),
e AS (SELECT y, {_EASTER_SQL} AS easter FROM {_COMPUTUS})
SELECT o_orderkey, easter, CAST(d - easter AS INTEGER) AS easter_offset,
  CAST((d - easter BETWEEN -5 AND 4) OR (d - easter BETWEEN 40 AND 47) AS INTEGER) AS easter_window,
  CAST(month(d) = 12 AND day(d) BETWEEN 24 AND 31 AS INTEGER) AS xmas_week,
  last_day(make_date(y, 6, 1)) - CAST((isodow(last_day(make_date(y, 6, 1))) - 3 + 7) % 7 AS INTEGER) AS last_wed_june,
  make_date(y, 11, 1) + CAST((7 - isodow(make_date(y, 11, 1))) % 7 AS INTEGER) AS first_sun_nov
FROM o JOIN e USING (y)""")
def c29_easter_and_anchors(t):
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    off = C.easter_offset("d")
    y = F.year("d")
    return o.select("o_orderkey", C.easter_date(y).alias("easter"), off.alias("easter_offset"),
                    (off.between(-5, 4) | off.between(40, 47)).cast("int").alias("easter_window"),
                    ((F.month("d") == 12) & F.dayofmonth("d").between(24, 31)).cast("int").alias("xmas_week"),
                    C.last_weekday_of_month(y, 6, "Wed").alias("last_wed_june"),
                    C.first_weekday_of_month(y, 11, "Sun").alias("first_sun_nov"))


@register("c32_yearly_lookup", "F32 F35", "o_orderkey:i gdp:f gdp_log:f", sql=f"""
WITH g AS (SELECT n.n_nationkey AS c_nationkey, year(o.o_orderdate) AS year, {ESUM('o.o_totalprice')} / 1e6 AS gdp
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
           GROUP BY ALL)
SELECT o.o_orderkey, g.gdp, ln(g.gdp) AS gdp_log FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN g ON c.c_nationkey = g.c_nationkey AND year(o.o_orderdate) = g.year""")
def c32_yearly_lookup(t):
    oc = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    gdp = oc.groupBy("c_nationkey", F.year("o_orderdate").alias("year")).agg(
        (exact_sum("o_totalprice") / 1e6).alias("gdp"))
    return C.yearly_lookup(oc, gdp, ["c_nationkey"], "o_orderdate", "gdp").select("o_orderkey", "gdp", "gdp_log")


# --------------------------------------------------------------------------- P-series on lineitem / customer
@register("p06_derived_columns", "P6 P7 P8 P9 P10 P11 P18 P20 P22 P23 P33 F35",
          "l_orderkey:i l_linenumber:i gross:f disc_ratio:f is_big:i size_class:s flag_rank:i flag_norm:s "
          "qty_clipped:f tax_floor:f level:f log_price:f rounded:f", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 + l_tax) AS gross,
  l_discount / (l_tax + 1e-6) AS disc_ratio, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS is_big,
  CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
  CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 1 WHEN 'R' THEN 0 END AS flag_rank,
  CASE WHEN l_returnflag = 'N' THEN 'NONE' ELSE l_returnflag END AS flag_norm,
  least(greatest(l_quantity, 5), 40) AS qty_clipped, greatest(l_tax - 0.04, 0) AS tax_floor,
  (l_discount + 1) * l_quantity AS level, ln(l_extendedprice) AS log_price,
  round_even(l_extendedprice / 7, 2) AS rounded
FROM lineitem""")
def p06_derived_columns(t):
    li = t.lineitem
    q = F.col("l_quantity")
    return li.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("gross"),
        P.safe_ratio("l_discount", "l_tax", 1e-6).alias("disc_ratio"), P.flag(q > 25).alias("is_big"),
        F.when(q < 10, "small").when(q < 30, "medium").otherwise("large").alias("size_class"),
        P.recode("l_returnflag", {"A": 2, "N": 1, "R": 0}).cast("int").alias("flag_rank"),
        P.recode("l_returnflag", {"N": "NONE"}).alias("flag_norm"),
        P.clip("l_quantity", 5, 40).alias("qty_clipped"), P.clip(F.col("l_tax") - 0.04, 0).alias("tax_floor"),
        P.ratio_to_level("l_discount", "l_quantity").alias("level"), F.ln("l_extendedprice").alias("log_price"),
        P.np_round(F.col("l_extendedprice") / 7, 2).alias("rounded"))


@register("p12_filters", "P12 P13 P14 P15 P16 P17 P31", "l_returnflag:s n:i", sql="""
SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_quantity >= 10 AND l_linestatus = 'F' AND l_suppkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
  AND l_shipdate IS NOT NULL AND l_tax = l_tax
  AND NOT (l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01')
GROUP BY l_returnflag""")
def p12_filters(t):
    li = t.lineitem
    keep = ((F.col("l_quantity") >= 10) & (F.col("l_linestatus") == "F")
            & F.col("l_suppkey").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
            & F.col("l_shipdate").isNotNull() & ~F.isnan("l_tax")
            & P.outside_range("l_shipdate", "1997-01-01 00:00:00", "1998-01-01 00:00:00"))
    return li.where(keep).dropna(subset=["l_shipdate"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("p19_parse_trimmed", "P19 P24 P25 P32", "c_custkey:i nation_num:f label0:i", sql="""
SELECT c_custkey, TRY_CAST(substr(c_name || 'x', 1, length(c_name || 'x') - 1) AS DOUBLE) AS nation_num,
  c_nationkey - 3 AS label0
FROM customer""")
def p19_parse_trimmed(t):
    c = t.customer
    return c.select("c_custkey", P.parse_trimmed_number(F.concat("c_name", F.lit("x"))).alias("nation_num"),
                    P.shift_label("c_nationkey", -3).alias("label0"))


@register("p25_positional_slice", "P25 O1", "o_orderkey:i", sql="""
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders)
WHERE rn >= 1000 AND rn < 1100""")
def p25_positional_slice(t):
    return P.positional_slice(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
                              1000, 1100).select("o_orderkey")


@register("p34_composition", "P34 P30 P2 P5 P3", "l_orderkey:i l_linenumber:i total:f l_quantity_share:f "
          "l_discount_share:f l_tax_share:f l_quantity_per_l_discount:f score:f", sql="""
SELECT l_orderkey, l_linenumber, l_quantity + l_discount + l_tax AS total,
  l_quantity / (l_quantity + l_discount + l_tax + 1e-6) AS l_quantity_share,
  l_discount / (l_quantity + l_discount + l_tax + 1e-6) AS l_discount_share,
  l_tax / (l_quantity + l_discount + l_tax + 1e-6) AS l_tax_share,
  l_quantity / (l_discount + 1e-6) AS l_quantity_per_l_discount,
  0.5 + l_quantity * 0.1 + l_discount * -2.0 AS score
FROM lineitem""")
def p34_composition(t):
    li = P.select_numeric(P.select_prefix(t.lineitem, "l_q", "l_d", "l_t", keep=["l_orderkey", "l_linenumber"]))
    comp = P.composition_features(["l_quantity", "l_discount", "l_tax"])
    return li.select("l_orderkey", "l_linenumber", comp["total"].alias("total"),
                     *[comp[f"{c}_share"].alias(f"{c}_share") for c in ["l_quantity", "l_discount", "l_tax"]],
                     comp["l_quantity_per_l_discount"].alias("l_quantity_per_l_discount"),
                     P.linear_score({"l_quantity": 0.1, "l_discount": -2.0}, 0.5).alias("score"))


@register("a09_first_per_group", "A9 O1", "d:d first_custkey:i", sql="""
SELECT CAST(o_orderdate AS DATE) AS d, arg_min(o_custkey, o_orderkey) AS first_custkey FROM orders GROUP BY ALL""")
def a09_first_per_group(t):
    o = t.orders
    return o.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.min_by("o_custkey", "o_orderkey").alias("first_custkey"))


_PRIO_W = {"1-URGENT": 5.0, "2-HIGH": 4.0, "3-MEDIUM": 3.0, "4-NOT SPECIFIED": 2.0, "5-LOW": 1.0}


@register("p29_calendar_repair", "P29 F44 P26 F34", "o_orderkey:i day_fixed:i prio_weight:f n_lines:i", sql="""
SELECT o.o_orderkey, least(day(o.o_orderdate) + 3, day(last_day(make_date(year(o.o_orderdate), month(o.o_orderdate), 1))))
  AS day_fixed, CASE o.o_orderpriority WHEN '1-URGENT' THEN 5.0 WHEN '2-HIGH' THEN 4.0 WHEN '3-MEDIUM' THEN 3.0
  WHEN '4-NOT SPECIFIED' THEN 2.0 WHEN '5-LOW' THEN 1.0 END AS prio_weight, l.n_lines
FROM orders o JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey""")
def p29_calendar_repair(t):
    o = t.orders
    a = o.select("o_orderkey", C.repair_day(F.year("o_orderdate"), F.month("o_orderdate"),
                                            F.dayofmonth("o_orderdate") + 3).alias("day_fixed"),
                 P.recode("o_orderpriority", _PRIO_W).cast("double").alias("prio_weight"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    return P.side_by_side(a, b, "o_orderkey")                                      # P26: join on id


def _flags_frame(t):
    o = t.orders
    return o.select("o_orderkey", F.col("o_totalprice").alias("a"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("inf"))).otherwise(F.col("o_totalprice"))
                    .alias("b"),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("c"),
                    (F.col("o_custkey") * 1.0).alias("d"))


@register("p27_drop_bad_columns", "P27 P28", "kind:s kept:s", sql="""
WITH f AS (SELECT o_totalprice AS a, CASE WHEN o_orderpriority = '1-URGENT' THEN 'inf'::DOUBLE ELSE o_totalprice END AS b,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS c, o_custkey * 1.0 AS d FROM orders),
s AS (SELECT coalesce(max(isinf(a)), false) AS ia, coalesce(max(isinf(b)), false) AS ib,
             coalesce(max(isinf(c)), false) AS ic, coalesce(max(isinf(d)), false) AS idd,
             count(*) - count(a) AS na, count(*) - count(b) AS nb, count(*) - count(c) AS nc, count(*) - count(d) AS nd
      FROM f)
SELECT 'no_inf' AS kind, array_to_string(list_filter([CASE WHEN NOT ia THEN 'a' END, CASE WHEN NOT ib THEN 'b' END,
  CASE WHEN NOT ic THEN 'c' END, CASE WHEN NOT idd THEN 'd' END], lambda x: x IS NOT NULL), ',') AS kept FROM s
UNION ALL
SELECT 'no_null', array_to_string(list_filter([CASE WHEN na = 0 THEN 'a' END, CASE WHEN nb = 0 THEN 'b' END,
  CASE WHEN nc = 0 THEN 'c' END, CASE WHEN nd = 0 THEN 'd' END], lambda x: x IS NOT NULL), ',') FROM s""")
def p27_drop_bad_columns(t):
    f = _flags_frame(t)
    cols = ["a", "b", "c", "d"]
    no_inf = P.drop_inf_columns(f, cols).columns
    no_null = P.drop_null_columns(f, cols).columns
    return t.spark.createDataFrame([("no_inf", ",".join(c for c in no_inf if c in cols)),
                                    ("no_null", ",".join(c for c in no_null if c in cols))], "kind string, kept string")
