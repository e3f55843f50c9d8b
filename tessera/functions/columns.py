"""Projection, predicate and scalar Column builders (SURVEY 2.2 P1-P34,
2.8 F35, F42-F44)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- P1-P5 projections
def select_prefix(df: DataFrame, *prefixes: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns whose name starts with a prefix (P2), plus ``keep``."""
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefixes) and c not in keep])


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``select_dtypes(include=np.number)`` (P5)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.select(*keep, *[c for c in num if c not in keep])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of all columns."""
    return df.toDF(*names)


# ---------------------------------------------------------------- P6-P11, P20-P23 expressions
def safe_ratio(a, b, eps: float = 0.0) -> Column:
    """a / (b + eps) (P6); null instead of an error on a zero denominator."""
    return F.try_divide(_c(a), _c(b) + F.lit(eps)) if eps else F.try_divide(_c(a), _c(b))


def flag(cond: Column) -> Column:
    """0/1 from a predicate."""
    return F.when(cond, 1).otherwise(0)


def recode(col, mapping: dict, default=None) -> Column:
    """Multi-branch recode / ordinal mapping / synonym normalisation (P8,
    P9, P11, F44) as a literal map lookup; unmapped values get ``default``
    (or keep themselves when ``default`` is None)."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    v = m[_c(col)]
    return F.coalesce(v, _c(col) if default is None else F.lit(default))


def rare_to_other(col, keep: Sequence, other: str = "Other") -> Column:
    """Values outside an allow-list become 'Other' (P10)."""
    return F.when(_c(col).isin(list(keep)), _c(col)).otherwise(F.lit(other))


def overwrite(col, cond: Column, value) -> Column:
    """``df.loc[mask, c] = v`` (P20)."""
    return F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(_c(col))


def clip(col, lo=None, hi=None) -> Column:
    """Clip to bounds, one- or two-sided, null-preserving."""
    c = _c(col)
    if lo is not None:
        c = F.when(c.isNull(), c).otherwise(F.greatest(c, F.lit(lo)))
    if hi is not None:
        c = F.when(c.isNull(), c).otherwise(F.least(c, F.lit(hi)))
    return c


def outside_range(col, start, end) -> Column:
    """Half-open blackout predicate ``~((c >= a) & (c < b))``."""
    return ~((_c(col) >= F.lit(start)) & (_c(col) < F.lit(end)))


def parse_trimmed_number(col, drop_last: int = 1) -> Column:
    """Number after trimming the last character(s) (P19), e.g. '45a' -> 45;
    unparsable text gives null (``try_cast``)."""
    s = _c(col)
    return s.substr(F.lit(1), F.length(s) - drop_last).try_cast("double")


def linear_score(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """Hand-written linear score."""
    e = F.lit(intercept)
    for c, w in weights.items():
        e = e + F.col(c) * F.lit(w)
    return e


def shift_label(col, offset: int) -> Column:
    """Class label shift (P32), e.g. quality - 3 and back."""
    return _c(col) + F.lit(offset)


def ratio_to_level(pred, level) -> Column:
    """Ratio forecast turned back into a level (P33): (pred + 1) * level."""
    return (_c(pred) + 1) * _c(level)


def composition_features(cols: Sequence[str], eps: float = 1e-6, pairwise: bool = True) -> dict[str, Column]:
    """Row total, every component / (total + eps) and pairwise ratios."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    out = {"total": total}
    for c in cols:
        out[f"{c}_share"] = F.try_divide(F.col(c), total + F.lit(eps))
    if pairwise:
        for i, a in enumerate(cols):
            for b in cols[i + 1:]:
                out[f"{a}_per_{b}"] = F.try_divide(F.col(a), F.col(b) + F.lit(eps))
    return out


# ---------------------------------------------------------------- P25-P28 frame-level
def positional_slice(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """``loc[start:stop]`` by an explicit order (P25), via a rank from
    skew-safe running counts (no single-partition window)."""
    from ..operators.prefix import running_sums
    r = running_sums(df.withColumn("_one", F.lit(1)), list(order), ["_one"], prefix="_rn")
    return r.where((F.col("_rn_one") - 1 >= start) & (F.col("_rn_one") - 1 < stop)).drop("_one", "_rn_one")


def side_by_side(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``concat([a, b], axis=1)`` (P26): a join on an id, never a positional zip."""
    return df.join(other, key, "inner")


def columns_with(df: DataFrame, cols: Sequence[str], pred) -> list[str]:
    """Names of ``cols`` where ``pred(col)`` holds on at least one row, from
    one aggregate pass (P27 inf, P28 null)."""
    row = df.agg(*[F.max(pred(F.col(c)).cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 1]


def drop_inf_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P27."""
    bad = columns_with(df, cols, lambda c: c.isin(float("inf"), float("-inf")))
    return df.drop(*bad)


def drop_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P28."""
    return df.drop(*columns_with(df, cols, lambda c: c.isNull() | F.isnan(c)))


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Ingest rule: NaN becomes null in floating columns."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (cols or fl) if c in fl]
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- F35 math
def np_round(col, decimals: int = 0) -> Column:
    """numpy rounding (half to even)."""
    return F.bround(_c(col), decimals)


def log1p(col) -> Column:
    return F.log1p(_c(col))
