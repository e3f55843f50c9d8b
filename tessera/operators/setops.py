"""Set operations and duplicate handling."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``pd.concat`` of frames by column name (U1; U2 with missing columns)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def stack_sources(frames: dict[str, DataFrame], flag: str = "source") -> DataFrame:
    """Union with a provenance column (P24): ``{name: frame}``."""
    return union_all([f.withColumn(flag, F.lit(k)) for k, f in frames.items()], allow_missing=True)


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows on a column subset."""
    return df.select(*cols).distinct()


def duplicate_flags(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``duplicated(keep='first')`` on a subset (U4): 1 for every copy after
    the first by ``order``.  The first copy is found by an aggregate (min of
    the order key per subset value), then joined back: a hot duplicate value
    is combined map-side instead of being sorted in one window task."""
    okey = F.struct(*[F.col(o) for o in order])
    firsts = df.groupBy(*[F.col(c).alias(f"_k_{c}") for c in cols]).agg(F.min(okey).alias("_first"))
    j = df.join(firsts, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cols], "left")
    return j.select(*df.columns, (okey != F.col("_first")).cast("int").alias("is_duplicate"))


def identical_columns(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Pairs of columns equal on every row (U5/U6, ``getDuplicateColumns``).

    Pass 1 (one aggregate): per column two order-free fingerprints, the
    decimal sums of two 64-bit hashes of (row key, value).  Columns with equal
    fingerprints are candidates (at most ``len(cols)^2`` pairs, collected).
    Pass 2 (one aggregate): exact count of rows where a candidate pair differs
    (null-safe).  Returns (a, b) with a before b in ``cols``.
    """
    cols = list(cols)
    spark = df.sparkSession
    fp = df.agg(*[F.sum(F.xxhash64(F.col(key), F.col(c)).cast("decimal(38,0)")).alias(f"a{i}")
                  for i, c in enumerate(cols)],
                *[F.sum(F.hash(F.col(key), F.col(c), F.lit(7)).cast("decimal(38,0)")).alias(f"b{i}")
                  for i, c in enumerate(cols)]).first()
    sig = [(fp[f"a{i}"], fp[f"b{i}"]) for i in range(len(cols))]
    cand = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols)) if sig[i] == sig[j]]
    if not cand:
        return spark.createDataFrame([], "a string, b string")
    diffs = df.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{k}") for k, (a, b) in enumerate(cand)]).first()
    same = [(a, b) for k, (a, b) in enumerate(cand) if diffs[f"d{k}"] == 0]
    return spark.createDataFrame(same, "a string, b string")


def drop_identical_columns(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Drop the later copy of every identical column pair."""
    pairs = identical_columns(df, key, cols).collect()
    return df.drop(*{r["b"] for r in pairs})


def intersect_on(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct feature vectors present in both."""
    return df.select(*cols).intersect(other.select(*cols))


def except_on(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose feature vector is absent from ``other`` (U8)."""
    return df.join(other.select(*cols).distinct(), list(cols), "left_anti")


def unseen_categories(test: DataFrame, train: DataFrame, col: str) -> DataFrame:
    """Distinct test categories with a flag for presence in train."""
    tr = train.select(col).distinct().withColumn("in_train", F.lit(1))
    return test.select(col).distinct().join(tr, col, "left").select(
        col, F.coalesce("in_train", F.lit(0)).alias("in_train"))
