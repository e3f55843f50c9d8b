"""Joins.

Broadcast hints are given only to inputs whose size is bounded by
construction (fixed lookup tables, calendars keyed by year, one row per
slice).  Everything else is left to Spark's size estimate and AQE, which
convert a join to broadcast only under ``spark.sql.autoBroadcastJoinThreshold``
and split skewed partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import range_slices


# ---------------------------------------------------------------- J1-J3, J5-J9
def left_join(df: DataFrame, other: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join on one or more shared key names (J1, J2, J6 with how='right')."""
    return df.join(other, on if isinstance(on, list) else [on], how)


def chain_join(base: DataFrame, blocks: Sequence[DataFrame], on, how: str = "left") -> DataFrame:
    """N-way join of feature blocks on one key."""
    return reduce(lambda a, b: a.join(b, on, how), blocks, base)


def join_keys(df: DataFrame, other: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
              how: str = "left") -> DataFrame:
    """Join with different key names."""
    cond = [df[a] == other[b] for a, b in zip(left_on, right_on)]
    return df.join(other, cond, how)


def natural_join(df: DataFrame, other: DataFrame, how: str = "left") -> DataFrame:
    """Join on all common column names (J7, pandas ``merge`` default)."""
    common = [c for c in df.columns if c in set(other.columns)]
    return df.join(other, common, how)


def suffix_join(df: DataFrame, other: DataFrame, on, how: str = "inner",
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join with pandas-style suffixes on clashing non-key columns."""
    on = [on] if isinstance(on, str) else list(on)
    clash = (set(df.columns) & set(other.columns)) - set(on)
    a = df.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in df.columns])
    b = other.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in other.columns])
    return a.join(b, on, how)


def map_lookup(df: DataFrame, key: str, mapping: dict, out: str) -> DataFrame:
    """Dictionary lookup (J9/F44) against a fixed literal mapping: a
    ``create_map`` expression, no join at all."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return df.withColumn(out, m[F.col(key)])


def lookup_join(df: DataFrame, table: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """Lookup against a table (J9).  ``bounded=True`` asserts the table is a
    fixed-size dimension and broadcasts it; otherwise Spark decides."""
    return df.join(F.broadcast(table) if bounded else table, key, "left")


# ---------------------------------------------------------------- J10-J12
def semi_join(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Keep rows whose key is in ``ids``."""
    return df.join(ids, on, "left_semi")


def anti_join(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Drop rows whose key is in ``ids``."""
    return df.join(ids, on, "left_anti")


def override_join(df: DataFrame, overrides: DataFrame, on, col: str, override_col: str | None = None) -> DataFrame:
    """Left join then prefer the override value when present."""
    oc = override_col or f"{col}_override"
    o = overrides.withColumnRenamed(col, oc) if override_col is None else overrides
    return df.join(o, on, "left").withColumn(col, F.coalesce(F.col(oc), F.col(col))).drop(oc)


# ---------------------------------------------------------------- J4 / U7 leakage match
def feature_match(test: DataFrame, train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Test rows whose full feature vector occurs in train (J4): train is
    first reduced to one row per feature vector (count, mean target), then
    joined null-safely, so duplicated feature vectors never fan out into
    pairs.  Adds ``n_train`` and ``train_target`` (null when unmatched)."""
    g = train.groupBy(*features).agg(F.count(F.lit(1)).alias("n_train"), F.avg(target).alias("train_target"))
    g = g.select(*[F.col(c).alias(f"_k_{c}") for c in features], "n_train", "train_target")
    cond = [test[c].eqNullSafe(g[f"_k_{c}"]) for c in features]
    return test.join(g, cond, "left").drop(*[f"_k_{c}" for c in features])


# ---------------------------------------------------------------- J13 as-of next-greater lookup
def asof_next(probe: DataFrame, ref: DataFrame, key: str, value: str, out: str,
              slices: int | None = None) -> DataFrame:
    """For each probe row, ``value`` of the reference row with the smallest
    ``key`` >= the probe key (J13, ``bisect_left`` lookup).  Reference and
    probe rows are ordered together (probe first on equal keys) and each
    probe takes the next reference value after it.  The scan runs in range
    slices; a probe with no reference row later in its slice takes the first
    reference value of the following slices, from a one-row-per-slice table.
    """
    prow = F.struct(*[F.col(f"`{c}`") for c in probe.columns])
    # _tb spreads rows with an equal key over several slices (a range partitioner
    # cannot split identical sort keys, so a hot probe value would land in one task)
    pk = probe.select(F.col(key).alias("_k"), F.lit(0).alias("_side"), prow.alias("_prow"),
                      F.xxhash64(prow).alias("_tb"))
    # the value travels in a struct, so that a null value still is the next row's value
    r = ref.select(F.col(key).alias("_k"), F.lit(1).alias("_side"), F.struct(F.col(value).alias("v")).alias("_v"),
                   F.lit(None).cast(pk.schema["_prow"].dataType).alias("_prow"),
                   F.xxhash64(F.col(key), F.col(value)).alias("_tb"))
    u = r.unionByName(pk.withColumn("_v", F.lit(None).cast(r.schema["_v"].dataType)))
    ranged, field, order_cols, _ = range_slices(u, [], ["_k", "_side", "_tb"], slices)
    w = (Window.partitionBy("_slice").orderBy(*order_cols)
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    loc = ranged.select("_slice", "_row", F.first(field("_v"), ignorenulls=True).over(w).alias("_nv"))
    firsts = ranged.groupBy("_slice").agg(
        F.count("_row").alias("_rows"),
        F.min_by(field("_v"), F.when(field("_v").isNotNull(),
                                     F.struct(field("_k"), field("_side"), field("_tb")))).alias("_fv"))
    nxt = firsts.select("_slice", F.first("_fv", ignorenulls=True).over(
        Window.orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    res = loc.join(F.broadcast(nxt), "_slice", "left")   # one row per slice: bounded by slice count
    return res.where(field("_side") == 0).select(
        *[field("_prow").getField(c).alias(c) for c in probe.columns], F.coalesce("_nv", "_after").getField("v").alias(out))


# ---------------------------------------------------------------- J14-J15 calendar joins
def interval_flags(df: DataFrame, date_col: str, windows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Interval membership flags (J14).  ``windows(year, window, start, end)``
    is pivoted to one row per year (a fixed number of windows per year, so
    it is bounded by the calendar span and broadcast), equi-joined on year,
    and each window becomes a 0/1 column named after it; every input row is
    kept once."""
    wide = windows.groupBy("year").pivot("window", list(names)).agg(
        F.first("start").alias("s"), F.first("end").alias("e"))
    d = df.withColumn("_y", F.year(date_col)).join(F.broadcast(wide.withColumnRenamed("year", "_y")), "_y", "left")
    day = F.to_date(F.col(date_col))
    for n in names:
        d = d.withColumn(n, F.coalesce(day.between(F.col(f"{n}_s"), F.col(f"{n}_e")).cast("int"), F.lit(0)))
    return d.drop("_y", *[f"{n}_s" for n in names], *[f"{n}_e" for n in names])


def holiday_join(df: DataFrame, holidays: DataFrame, on: Sequence[str], dedupe: bool = True) -> DataFrame:
    """Left join to a holiday calendar (J15); with ``dedupe`` several holidays
    on one date collapse to the first by name instead of fanning out (J20)."""
    h = holidays
    if dedupe:
        h = holidays.groupBy(*on).agg(F.min("holiday").alias("holiday"), F.count(F.lit(1)).alias("n_holidays"))
    return df.join(F.broadcast(h), list(on), "left")


# ---------------------------------------------------------------- J19 self lookup of previous period
def previous_period(df: DataFrame, keys: Sequence[str], period: str, cols: Sequence[str], step: int = 1) -> DataFrame:
    """Join period t-``step`` values onto period t (J19) by an equi-join on
    (keys, period) — works for gaps, unlike a positional lag."""
    prev = df.select(*keys, (F.col(period) + step).alias(period),
                     *[F.col(c).alias(f"{c}_prev") for c in cols])
    return df.join(prev, [*keys, period], "left")
