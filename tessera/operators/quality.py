"""Data-quality operators: profiles, duplicates, outliers, imputation
(SURVEY 2.4 A22, 2.7 U3-U6, 2.9 X9-X17, W15)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import grouped_quantiles
from .prefix import exact_sum


# ---------------------------------------------------------------- A22 describe
def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe()`` as a long table: count, mean, std, min, quartiles, max
    per column.  Columns are unpivoted so every statistic is one grouped
    aggregate; quartiles are exact and skew-safe.
    A column of nulls has count 0 and null statistics."""
    long = df.unpivot([], list(cols), "column", "v").select("column", F.col("v").cast("double").alias("v"))
    base = long.groupBy("column").agg(
        F.count("v").alias("count"), F.try_divide(exact_sum("v"), F.count("v")).alias("mean"),
        F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    q = grouped_quantiles(long, ["column"], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return base.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
