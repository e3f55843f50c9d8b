"""Sorts, limits, top-k and reproducible sampling.

Randomness is a seeded hash of a row key (md5 of ``key:seed``), never
``rand()`` over a partitioning that can change between runs, so folds and
samples are reproducible and identical when recomputed after a lost task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running_sums


def stable_hash(key, seed: int = 0) -> Column:
    """Deterministic 32-bit hash in [0, 2^32) of ``key`` and ``seed``: the
    first 8 hex digits of md5("key:seed") (same value in any SQL engine
    with md5)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")


def uniform(key, seed: int = 0) -> Column:
    """Reproducible pseudo-uniform number in [0, 1) from a row key."""
    return stable_hash(key, seed) / F.lit(4294967296.0)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Best-k rows by score (O3): ``orderBy.limit`` plans as
    TakeOrderedAndProject — a per-partition top-k merged, never a full sort."""
    return df.orderBy(*order).limit(k)


def top_bottom(df: DataFrame, score: str, k: int, key: str) -> DataFrame:
    """Top-k and bottom-k rows by score (O4) with a side label."""
    top = df.orderBy(F.desc(score), F.asc(key)).limit(k).withColumn("side", F.lit("top"))
    bot = df.orderBy(F.asc(score), F.asc(key)).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bot)


def tail(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Last k rows by order (O2): reverse order + limit."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(k)


def cumulative_weight_cut(df: DataFrame, score: str, tie: str, weight: str, share: float) -> DataFrame:
    """Rows whose cumulative weight by descending score stays within
    ``share`` of the total weight (O5, the top-4 % cut)."""
    cum = running_sums(df, [(score, "desc"), tie], [weight], totals=True)
    return cum.where(F.col(f"cum_{weight}") <= F.floor(F.lit(share) * F.col(f"tot_{weight}")))


def argmax_class(arr: Column) -> Column:
    """0-based index of the largest element (O6, ``np.argmax``)."""
    return F.array_position(arr, F.array_max(arr)) - 1


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Reproducible row shuffle (O7): order by a seeded hash of the key."""
    return df.orderBy(stable_hash(key, seed), F.col(key))


def shuffle_column(df: DataFrame, key: str, col: str, seed: int = 0, slices: int | None = None) -> DataFrame:
    """Permute one column across rows (O8, null-target shuffle): rank rows by
    key and by a seeded hash, then join rank to rank.  Ranks are skew-safe
    running counts; the result is a true permutation of the column."""
    base = df.select(key, col).withColumn("_one", F.lit(1))
    by_key = running_sums(base.select(key, "_one"), [key], ["_one"], slices=slices, prefix="r")
    by_hash = running_sums(base.withColumn("_h", stable_hash(key, seed)).select("_h", key, col, "_one"),
                           ["_h", key], ["_one"], slices=slices, prefix="r")
    perm = by_hash.select(F.col("r_one").alias("_r"), F.col(col).alias(f"{col}_shuffled"))
    return df.join(by_key.select(key, F.col("r_one").alias("_r")), key).join(perm, "_r").drop("_r")


def sample_entities(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Rows of ``n`` whole entities chosen by seeded hash (O9): distinct
    ids, hash-ordered limit (top-k, not a sort), semi join."""
    ids = df.select(key).distinct().withColumn("_h", stable_hash(key, seed)).orderBy("_h", key).limit(n)
    return df.join(ids.select(key), key, "left_semi")


def holdout(df: DataFrame, key: str, test_share: float, seed: int = 0, stratify: str | None = None,
            slices: int | None = None) -> DataFrame:
    """Random hold-out split (O10) as a 0/1 ``is_test`` column.  Plain:
    hash below the share.  Stratified: within each class, rows ranked by
    seeded hash and the first round(share * class size) go to test, so
    every class keeps its proportion exactly."""
    if stratify is None:
        return df.withColumn("is_test", (uniform(key, seed) < test_share).cast("int"))
    b = df.withColumn("_h", stable_hash(key, seed)).withColumn("_one", F.lit(1))
    r = running_sums(b, ["_h", key], ["_one"], groups=[stratify], slices=slices, prefix="r", totals=True)
    cut = F.round(F.lit(test_share) * F.col("tot__one"))
    return r.withColumn("is_test", (F.col("r_one") <= cut).cast("int")).drop("_h", "_one", "r_one", "tot__one")
