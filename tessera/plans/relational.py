"""Join, set-operation and ordering queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import setops as U
from ..operators import windows as W
from ..operators.prefix import exact_sum
from .registry import ESUM, register


def SQL_HASH(key: str, seed: int) -> str:
    """SQL twin of ``ordering.stable_hash``."""
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"


def SQL_UNIFORM(key: str, seed: int) -> str:
    return f"({SQL_HASH(key, seed)} / 4294967296.0)"


# --------------------------------------------------------------------------- J1-J3, J5, J9
@register("j01_star_join", "J1 J2 J3 J5 J9 P1 P6", "r_name:s year:i revenue:f n_lines:i", sql=f"""
SELECT r.r_name, year(o.o_orderdate) AS year,
       {ESUM('l.l_extendedprice * (1 - l.l_discount)')} AS revenue, count(*) AS n_lines
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ALL""")
def j01_star_join(t):
    li = t.lineitem.select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    o = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = t.customer.select("c_custkey", "c_nationkey")
    x = J.join_keys(li, o, ["l_orderkey"], ["o_orderkey"])                       # J5 different key names
    x = J.join_keys(x, c, ["o_custkey"], ["c_custkey"])
    # nation / region: fixed-size dimensions (25 / 5 rows)
    x = J.lookup_join(x.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey", bounded=True)
    x = J.lookup_join(x.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "r_regionkey", bounded=True)
    return x.groupBy("r_name", "year").agg(exact_sum("rev").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))


# --------------------------------------------------------------------------- J4 / U7 / E10
_FEAT = ["l_partkey", "l_quantity", "l_returnflag"]
_SPLIT_SQL = f"""(SELECT *, CASE WHEN {SQL_UNIFORM('l_orderkey', 1)} < 0.7 THEN 'train' ELSE 'test' END AS part,
       CAST(l_linestatus = 'F' AS INTEGER) AS target FROM lineitem)"""


def _split(t):
    return t.lineitem.withColumn("part", F.when(O.uniform("l_orderkey", 1) < 0.7, "train").otherwise("test")) \
                     .withColumn("target", (F.col("l_linestatus") == "F").cast("int"))


@register("j04_leakage_match", "J4 U7 E10 J12", "l_partkey:i l_quantity:f l_returnflag:s n_test:i n_train:i "
          "train_target:f flipped:f", sql=f"""
WITH s AS {_SPLIT_SQL},
tr AS (SELECT l_partkey, l_quantity, l_returnflag, count(*) AS n_train, avg(target) AS train_target
       FROM s WHERE part = 'train' GROUP BY ALL),
te AS (SELECT l_partkey, l_quantity, l_returnflag, count(*) AS n_test FROM s WHERE part = 'test' GROUP BY ALL)
SELECT te.l_partkey, te.l_quantity, te.l_returnflag, n_test, n_train, train_target, 1 - train_target AS flipped
FROM te JOIN tr ON te.l_partkey IS NOT DISTINCT FROM tr.l_partkey
  AND te.l_quantity IS NOT DISTINCT FROM tr.l_quantity AND te.l_returnflag IS NOT DISTINCT FROM tr.l_returnflag""")
def j04_leakage_match(t):
    s = _split(t)
    test = s.where(F.col("part") == "test").groupBy(*_FEAT).agg(F.count(F.lit(1)).alias("n_test"))
    m = J.feature_match(test, s.where(F.col("part") == "train"), _FEAT, "target")
    return m.where(F.col("n_train").isNotNull()).withColumn("flipped", 1 - F.col("train_target"))


# --------------------------------------------------------------------------- J6
@register("j06_right_join", "J6", "c_custkey:i n_orders:i", sql="""
SELECT c.c_custkey, count(o.o_orderkey) AS n_orders
FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""")
def j06_right_join(t):
    o, c = t.orders, t.customer
    j = o.join(c, o.o_custkey == c.c_custkey, "right")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


# --------------------------------------------------------------------------- J7 / J8
@register("j07_natural_join", "J7 J2", "l_orderkey:i l_returnflag:s qty:f price:f", sql=f"""
SELECT a.l_orderkey, a.l_returnflag, qty, price FROM
 (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL) a
 LEFT JOIN (SELECT l_orderkey, l_returnflag, {ESUM('l_extendedprice')} AS price FROM lineitem GROUP BY ALL) b
 ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag""")
def j07_natural_join(t):
    li = t.lineitem
    a = li.groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("qty"))
    b = li.groupBy("l_orderkey", "l_returnflag").agg(exact_sum("l_extendedprice").alias("price"))
    return J.natural_join(a, b)


@register("j08_suffix_join", "J8 P4", "o_orderkey:i pred_x:f pred_y:f", sql=f"""
SELECT a.o_orderkey, a.o_totalprice / 1e6 AS pred_x, {SQL_UNIFORM('b.o_orderkey', 3)} AS pred_y
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey""")
def j08_suffix_join(t):
    p1 = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1e6).alias("pred"))
    p2 = t.orders.select("o_orderkey", O.uniform("o_orderkey", 3).alias("pred"))
    return J.suffix_join(p1, p2, "o_orderkey")


# --------------------------------------------------------------------------- J10 / J11
@register("j10_semi_anti", "J10 J11 P13 U8", "l_returnflag:s n_semi:i n_anti:i", sql="""
SELECT l_returnflag,
  count(*) FILTER (WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS n_semi,
  count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS n_anti
FROM lineitem GROUP BY l_returnflag""")
def j10_semi_anti(t):
    ids = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    semi = J.semi_join(t.lineitem, ids, "l_orderkey").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_semi"))
    anti = J.anti_join(t.lineitem, ids, "l_orderkey").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_anti"))
    return semi.join(anti, "l_returnflag", "full").na.fill(0, ["n_semi", "n_anti"])


# --------------------------------------------------------------------------- J12
@register("j12_override_join", "J12 P20 P21", "c_custkey:i c_acctbal:f", sql="""
SELECT c.c_custkey, coalesce(p.v, c.c_acctbal) AS c_acctbal FROM customer c LEFT JOIN
  (SELECT o_custkey, max(o_totalprice) / 100 AS v FROM orders WHERE o_orderstatus = 'P'
   AND o_orderpriority = '1-URGENT' GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey""")
def j12_override_join(t):
    patch = t.orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")) \
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_totalprice") / 100).alias("c_acctbal"))
    return J.override_join(t.customer.select("c_custkey", "c_acctbal"), patch, "c_custkey", "c_acctbal")


# --------------------------------------------------------------------------- J13 / E6
@register("j13_asof_rank", "J13 W14 E6", "event_id:i rank:f", sql="""
WITH tr AS (SELECT value FROM events WHERE event_type <> 'purchase'),
r AS (SELECT DISTINCT value AS p, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r
      FROM tr)
SELECT e.event_id, (SELECT min_by(r, p) FROM r WHERE r.p >= e.value) AS rank
FROM events e WHERE e.event_type = 'purchase'""")
def j13_asof_rank(t):
    e = t.events.select("event_id", "event_type", "value")
    train = e.where(F.col("event_type") != "purchase")
    ranks = W.average_rank(train.select("value"), "value", out="r").distinct()
    test = e.where(F.col("event_type") == "purchase").select("event_id", "value")
    return J.asof_next(test, ranks, "value", "r", "rank")


# --------------------------------------------------------------------------- J14
@register("j14_interval_flags", "J14 F31 F24", "o_orderkey:i xmas:i black_friday:i", sql="""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y FROM orders),
w AS (SELECT y, make_date(y, 12, 15) AS xs, make_date(y, 12, 31) AS xe,
             make_date(y, 11, 1) + CAST((4 - isodow(make_date(y, 11, 1)) + 7) % 7 AS INTEGER) + 22 AS bs
      FROM (SELECT DISTINCT y FROM o))
SELECT o_orderkey, CAST(d BETWEEN xs AND xe AS INTEGER) AS xmas, CAST(d BETWEEN bs AND bs + 3 AS INTEGER) AS black_friday
FROM o JOIN w USING (y)""")
def j14_interval_flags(t):
    o = t.orders.select("o_orderkey", "o_orderdate")
    wins = C.season_windows(o.select(F.year("o_orderdate").alias("year")).distinct())
    return J.interval_flags(o, "o_orderdate", wins, ["xmas", "black_friday"]).select("o_orderkey", "xmas",
                                                                                      "black_friday")


# --------------------------------------------------------------------------- J15 / J20
def _holiday_sql() -> str:
    from ..functions.calendar import HOLIDAY_RULES
    easter = """make_date(y, ((h + l - 7 * m + 114) // 31), ((h + l - 7 * m + 114) % 31) + 1)"""
    comp = """(SELECT y, a, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM (
      SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
        SELECT y, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
          SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c, (y // 100) // 4 AS d, (y // 100) % 4 AS e,
                 ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 AS g, (y % 100) // 4 AS i, (y % 100) % 4 AS k
          FROM yrs))))"""
    rules = " UNION ALL ".join(
        f"SELECT {r} AS n_regionkey, "
        + (f"CAST({easter} + {d} AS DATE)" if m == 0 else f"make_date(y, {m}, {d})")
        + f" AS date, '{name}' AS holiday FROM {comp}" for r, m, d, name in HOLIDAY_RULES)
    return f"""
WITH o AS (SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS date, n.n_regionkey
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
yrs AS (SELECT DISTINCT CAST(year(date) AS INTEGER) AS y FROM o),
hol AS ({rules}),
h AS (SELECT n_regionkey, date, min(holiday) AS holiday, count(*) AS n_holidays FROM hol GROUP BY ALL)
SELECT o_orderkey, holiday, n_holidays FROM o JOIN h USING (n_regionkey, date)"""


@register("j15_holiday_join", "J15 J20 F29 F30", "o_orderkey:i holiday:s n_holidays:i", sql=_holiday_sql())
def j15_holiday_join(t):
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .join(F.broadcast(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")), "c_nationkey")
    o = o.withColumn("date", F.to_date("o_orderdate"))
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    hol = C.holiday_table(years)
    j = J.holiday_join(o, hol, ["n_regionkey", "date"])
    return j.where(F.col("holiday").isNotNull()).select("o_orderkey", "holiday", "n_holidays")


# --------------------------------------------------------------------------- J19
@register("j19_previous_period", "J19 W2", "o_custkey:i period:i v:f v_prev:f", sql=f"""
WITH m AS (SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS period, {ESUM('o_totalprice')} AS v
           FROM orders GROUP BY ALL)
SELECT a.o_custkey, a.period, a.v, b.v AS v_prev FROM m a LEFT JOIN m b
  ON a.o_custkey = b.o_custkey AND a.period = b.period + 1""")
def j19_previous_period(t):
    m = t.orders.groupBy("o_custkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("period")) \
        .agg(exact_sum("o_totalprice").alias("v"))
    return J.previous_period(m, ["o_custkey"], "period", ["v"])


# --------------------------------------------------------------------------- U1 / U2 / P24
@register("u01_union_sources", "U1 U2 P24", "source:s n:i n_with_price:i", sql="""
SELECT source, count(*) AS n, count(o_totalprice) AS n_with_price FROM (
  SELECT 'F' AS source, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'O', o_totalprice FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'P', NULL FROM orders WHERE o_orderstatus = 'P') GROUP BY source""")
def u01_union_sources(t):
    o = t.orders
    frames = {"F": o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"),
              "O": o.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice"),
              "P": o.where(F.col("o_orderstatus") == "P").select("o_orderkey")}      # target absent (U2)
    u = U.stack_sources(frames)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("n_with_price"))


# --------------------------------------------------------------------------- U3 / U4
@register("u03_distinct_pairs", "U3 A19", "o_orderstatus:s n_customers:i", sql="""
SELECT o_orderstatus, count(*) AS n_customers FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
GROUP BY o_orderstatus""")
def u03_distinct_pairs(t):
    return U.distinct_on(t.orders, ["o_custkey", "o_orderstatus"]).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_customers"))


@register("u04_duplicate_flags", "U4", "o_orderkey:i is_duplicate:i", sql="""
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) > 1
       AS INTEGER) AS is_duplicate FROM orders""")
def u04_duplicate_flags(t):
    o = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return U.duplicate_flags(o, ["o_custkey", "d"], ["o_orderkey"]).select("o_orderkey", "is_duplicate")


# --------------------------------------------------------------------------- U5 / U6
def _wide_orders(t):
    o = t.orders
    return o.select("o_orderkey", F.col("o_totalprice").alias("p1"), (F.col("o_totalprice") * 1).alias("p2"),
                    F.col("o_custkey").alias("c1"), (F.col("o_custkey") + 0).alias("c2"),
                    (F.col("o_custkey") + 1).alias("c3"), F.col("o_orderstatus").alias("s1"))


_WIDE_SQL = """(SELECT o_orderkey, o_totalprice AS p1, o_totalprice * 1 AS p2, o_custkey AS c1, o_custkey + 0 AS c2,
                o_custkey + 1 AS c3, o_orderstatus AS s1 FROM orders)"""
_WIDE_COLS = ["p1", "p2", "c1", "c2", "c3", "s1"]
_WIDE_TYPES = {"p1": "d", "p2": "d", "c1": "i", "c2": "i", "c3": "i", "s1": "s"}


@register("u05_identical_columns", "U5 U6", "a:s b:s", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b FROM {_WIDE_SQL} w HAVING count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) = 0"
    for i, a in enumerate(_WIDE_COLS) for b in _WIDE_COLS[i + 1:] if _WIDE_TYPES[a] == _WIDE_TYPES[b]))
def u05_identical_columns(t):
    return U.identical_columns(_wide_orders(t), "o_orderkey", _WIDE_COLS)


# --------------------------------------------------------------------------- U7 / U8 / U9
@register("u07_intersect_except", "U7 U8", "n_intersect:i n_except:i", sql=f"""
WITH s AS {_SPLIT_SQL},
tr AS (SELECT DISTINCT l_partkey, l_quantity, l_returnflag FROM s WHERE part = 'train'),
te AS (SELECT DISTINCT l_partkey, l_quantity, l_returnflag FROM s WHERE part = 'test')
SELECT (SELECT count(*) FROM (SELECT * FROM te INTERSECT SELECT * FROM tr)) AS n_intersect,
       (SELECT count(*) FROM s WHERE part = 'test' AND (l_partkey, l_quantity, l_returnflag) NOT IN (SELECT * FROM tr))
         AS n_except""")
def u07_intersect_except(t):
    s = _split(t)
    tr, te = s.where(F.col("part") == "train"), s.where(F.col("part") == "test")
    n_int = U.intersect_on(te, tr, _FEAT).select(F.count(F.lit(1)).alias("n_intersect"))
    n_exc = U.except_on(te, tr, _FEAT).select(F.count(F.lit(1)).alias("n_except"))
    return n_int.select("n_intersect", n_exc.scalar().alias("n_except"))


@register("u09_unseen_categories", "U9", "l_partkey:i in_train:i", sql=f"""
WITH s AS {_SPLIT_SQL}
SELECT DISTINCT te.l_partkey, CASE WHEN tr.l_partkey IS NULL THEN 0 ELSE 1 END AS in_train
FROM (SELECT DISTINCT l_partkey FROM s WHERE part = 'test') te
LEFT JOIN (SELECT DISTINCT l_partkey FROM s WHERE part = 'train') tr USING (l_partkey)""")
def u09_unseen_categories(t):
    s = _split(t)
    return U.unseen_categories(s.where(F.col("part") == "test"), s.where(F.col("part") == "train"), "l_partkey")


# --------------------------------------------------------------------------- O3 / O4 / O2
@register("o03_top_k", "O3 O1", "o_orderkey:i o_totalprice:f", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def o03_top_k(t):
    return O.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 50)


@register("o04_top_bottom", "O4 O2", "c_custkey:i c_acctbal:f side:s", sql="""
(SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 8)
UNION ALL
(SELECT c_custkey, c_acctbal, 'bottom' FROM customer ORDER BY c_acctbal, c_custkey LIMIT 8)""")
def o04_top_bottom(t):
    return O.top_bottom(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 8, "c_custkey")


# --------------------------------------------------------------------------- O5
@register("o05_cumulative_cut", "O5 W13", "event_id:i", sql="""
WITH w AS (SELECT event_id, value, CASE WHEN event_type = 'error' THEN 20 ELSE 1 END AS wt FROM events),
c AS (SELECT event_id, sum(wt) OVER (ORDER BY value DESC, event_id ROWS UNBOUNDED PRECEDING) AS cw,
             sum(wt) OVER () AS tw FROM w)
SELECT event_id FROM c WHERE cw <= floor(0.04 * tw)""")
def o05_cumulative_cut(t):
    e = t.events.select("event_id", "value",
                        F.when(F.col("event_type") == "error", 20).otherwise(1).alias("wt"))
    return O.cumulative_weight_cut(e, "value", "event_id", "wt", 0.04).select("event_id")


# --------------------------------------------------------------------------- O6
@register("o06_argmax", "O6 F42", "vec_id:i argmax:i", sql="""
SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS argmax FROM embeddings""")
def o06_argmax(t):
    return t.embeddings.select("vec_id", O.argmax_class(F.col("embedding")).alias("argmax"))


# --------------------------------------------------------------------------- O7 / O8
@register("o07_shuffle_rows", "O7", "o_orderkey:i shuffle_pos:i", sql=f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {SQL_HASH('o_orderkey', 11)}, o_orderkey) AS shuffle_pos FROM orders""")
def o07_shuffle_rows(t):
    from ..operators.prefix import running_sums
    o = t.orders.select("o_orderkey", O.stable_hash("o_orderkey", 11).alias("_h"), F.lit(1).alias("n"))
    return running_sums(o, ["_h", "o_orderkey"], ["n"], prefix="pos_").select(
        "o_orderkey", F.col("pos_n").alias("shuffle_pos"))


@register("o08_shuffle_column", "O8", "o_orderkey:i price_shuffled:f", sql=f"""
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders),
b AS (SELECT o_totalprice, row_number() OVER (ORDER BY {SQL_HASH('o_orderkey', 5)}, o_orderkey) AS r FROM orders)
SELECT a.o_orderkey, b.o_totalprice AS price_shuffled FROM a JOIN b USING (r)""")
def o08_shuffle_column(t):
    return O.shuffle_column(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 5) \
        .select("o_orderkey", F.col("o_totalprice_shuffled").alias("price_shuffled"))


# --------------------------------------------------------------------------- O9 / O10
@register("o09_sample_entities", "O9", "o_custkey:i n_orders:i", sql=f"""
WITH ids AS (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
             ORDER BY {SQL_HASH('o_custkey', 2)}, o_custkey LIMIT 100)
SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_custkey IN (SELECT o_custkey FROM ids) GROUP BY o_custkey""")
def o09_sample_entities(t):
    return O.sample_entities(t.orders, "o_custkey", 100, seed=2).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"))


@register("o10_stratified_holdout", "O10", "o_orderkey:i is_test:i", sql=f"""
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY {SQL_HASH('o_orderkey', 9)}, o_orderkey)
       <= round(0.2 * count(*) OVER (PARTITION BY o_orderstatus)) AS INTEGER) AS is_test FROM orders""")
def o10_stratified_holdout(t):
    return O.holdout(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2, seed=9,
                     stratify="o_orderstatus").select("o_orderkey", "is_test")
