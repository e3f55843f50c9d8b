"""Skew-safe running sums and ranks.

A window ``partitionBy(g).orderBy(o)`` puts a whole group in one task, and a
window with no ``partitionBy`` puts the whole table in one task.  Running
sums here are computed in two levels instead:

1. cut (group keys, order keys) into ``slices`` ranges of similar size, so a
   hot group is spread over many slices; the range number is an expression;
2. running sums inside each (slice, group) — a local window, the one shuffle
   of the rows;
3. one row per (slice, group) with the slice total (combined map-side); a
   window over that small table (rows = groups + slices) gives the offset of
   every slice inside its group and the group's grand total;
4. local sum + offset.

The order keys must make the order total (add a unique tie-break) when the
caller needs a deterministic per-row result.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Values that this type holds unchanged are summed in it, so that the sum does
#: not depend on the order rows arrive in (double sums do, in the last bits).
EXACT = "decimal(38,6)"
#: Rows that a slice should hold at most.
SLICE_ROWS = 4_000_000
#: Sampled rows per slice, from which the split points are taken.
SPLIT_SAMPLE = 64


def as_exact(c) -> Column:
    """The value as ``EXACT``, null where that type would change it."""
    x = _col(c).cast("double")
    d = F.when(F.abs(x) < 1e18, x).try_cast(EXACT)
    return F.when(d.cast("double") == x, d)


def exact_sum(c) -> Column:
    """Sum as double: order-independent where all values have at most six
    decimals and are below 1e18, else the plain double sum."""
    x = _col(c).cast("double")
    d = as_exact(c)
    return F.when(F.count(d) == F.count(x), F.sum(d).cast("double")).otherwise(F.sum(x))


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """A single comparable key for an order, usable in ``max`` / ``max_by``."""
    return F.struct(*[F.col(o) for o in order])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_slices(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _default(dt):
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return None


def _split_points(keys: DataFrame, order_cols: Sequence[Column], slices: int | None) -> list:
    """Rows that cut ``keys`` into ranges of similar size, from a random row
    of each of ``SPLIT_SAMPLE`` buckets per slice, taken in one pass.  They
    shape the balance of the slices, never a result."""
    least = slices or default_slices(keys)
    if least < 2:
        return []
    dealt = keys.select(F.floor(F.rand(7) * (SPLIT_SAMPLE * least)).alias("b"),
                        F.struct(F.rand(11).alias("r"), F.struct(*keys.columns).alias("key")).alias("drawn"))
    got = dealt.groupBy("b").agg(F.count(F.lit(1)).alias("rows"), F.min("drawn")["key"].alias("key")).select(
        "rows", "key.*").repartition(1).sortWithinPartitions(*order_cols).collect()
    n = slices or min(max(least, -(-sum(r["rows"] for r in got) // SLICE_ROWS)), max(len(got), 1))
    return [got[len(got) * k // n][1:] for k in range(1, n)] if got else []


def _literal(v) -> Column:
    """A collected value, nested or not, as a literal."""
    if isinstance(v, tuple):
        return F.struct(*[_literal(x).alias(n) for x, n in zip(v, getattr(v, "__fields__", range(len(v))))])
    return F.array(*[_literal(x) for x in v]) if isinstance(v, list) else F.lit(v)


def _before(x: Column, s: Column, desc: bool) -> Column:
    """Does x sort before s (nulls first ascending, last descending)?"""
    if desc:
        return x.isNotNull() & (s.isNull() | (x > s))
    return s.isNotNull() & (x.isNull() | (x < s))


def _slice_number(names: Sequence[str], desc: Sequence[bool], tables: Sequence[Column], n: int) -> Column:
    """How many of the ``n`` split points do not lie after the row: a binary
    search as one fold over the step sizes.  The place reached so far is a
    lambda variable, so the expression stays small wherever the optimizer
    copies it to."""
    if not n:
        return F.lit(0)

    def probe(at: Column, step: Column) -> Column:
        earlier = F.lit(False)                         # is the row before the probed split point?
        for c, d, t in reversed(list(zip(names, desc, tables))):
            s = F.get(t, at + step - 1)
            earlier = _before(F.col(c), s, d) | (F.col(c).eqNullSafe(s) & earlier)
        return F.when((at + step <= n) & ~earlier, at + step).otherwise(at)
    steps = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(k) for k in steps]), F.lit(0), probe)


def range_slices(df: DataFrame, groups: Sequence[str], order: Sequence, slices: int | None = None):
    """Number the rows of ``df`` by range of (groups, order).

    Returns ``(ranged, field, order_cols, gkeys)``: ``ranged`` has columns
    ``_slice``, ``_row`` (a struct of all input columns) and non-null
    surrogate group keys ``gkeys`` (value with a type default + null flag,
    so null groups stay groups and every later window / aggregate / join on
    (``_slice``, *gkeys) uses plain equality on the same columns).
    ``field(name)`` reads a column out of ``_row``.

    The split points are taken once, when the plan is built, and stand in it
    as literals; ``_slice`` is a binary search among them.  It is thus a plain
    function of the row: consumers agree on it whatever columns each of them
    reads, a lost task computes it again alike, and nothing is cached.  The
    rows move once, in the consumer's window on (``_slice``, *gkeys).
    Groups are ordered by their hash, which keeps a group's rows together.
    """
    def field(c):
        return F.col("_row").getField(c)

    parsed = [(o, "asc") if isinstance(o, str) else o for o in order]
    order_cols = [field(o).desc() if d == "desc" else field(o).asc() for o, d in parsed]
    gexprs, gkeys = [], []
    for i, g in enumerate(groups):
        dflt = _default(df.schema[g].dataType)
        if dflt is None:                           # complex key: keep it as it is
            gexprs.append(field(g).alias(f"_k{i}"))
            gkeys.append(f"_k{i}")
        else:
            gexprs += [F.coalesce(field(g), dflt).alias(f"_k{i}"), field(g).isNull().alias(f"_n{i}")]
            gkeys += [f"_k{i}", f"_n{i}"]

    keys = ([F.xxhash64(*[F.col(f"`{g}`") for g in groups])] if groups else []) + [F.col(f"`{o}`") for o, _ in parsed]
    desc = ([False] if groups else []) + [d == "desc" for _, d in parsed]
    names = [f"_o{i}" for i in range(len(keys))]
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                      *[k.alias(n) for k, n in zip(keys, names)])
    splits = _split_points(keyed.select(*names), [F.col(n).desc() if d else F.col(n).asc()
                                                  for n, d in zip(names, desc)], slices)
    tables = [F.array(*[_literal(s[i]) for s in splits]).cast(T.ArrayType(keyed.schema[n].dataType))
              for i, n in enumerate(names)] if splits else []
    ranged = keyed.withColumn("_slice", _slice_number(names, desc, tables, len(splits)))
    return ranged.select("_slice", "_row", *gexprs), field, order_cols, gkeys


def running_sums(df: DataFrame, order: Sequence, values: Sequence[str],
                 groups: Sequence[str] = (), slices: int | None = None,
                 prefix: str = "cum_", totals: bool = False) -> DataFrame:
    """Add inclusive running sums ``{prefix}{v}`` of ``values`` ordered by
    ``order`` within ``groups`` (whole table when ``groups`` is empty).

    With ``totals=True`` also adds ``tot_{v}``: the sum over the whole group.
    ``order`` items are column names or (name, "desc") pairs.
    """
    groups = list(groups)
    cols = df.columns
    ranged, field, order_cols, gk = range_slices(df, groups, order, slices)
    part = ["_slice", *gk]
    w_local = (Window.partitionBy(*part).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select(*part, "_row", *[F.sum(field(v)).over(w_local).alias(f"_loc_{v}") for v in values])
    slice_tot = ranged.groupBy(*part).agg(
        F.count("_row").alias("_rows"), *[F.sum(field(v)).alias(f"_st_{v}") for v in values])
    w_before = Window.partitionBy(*gk).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*gk)
    offs = slice_tot.select(
        *part,
        *[F.coalesce(F.sum(f"_st_{v}").over(w_before), F.lit(0)).alias(f"_off_{v}") for v in values],
        *([F.sum(f"_st_{v}").over(w_all).alias(f"tot_{v}") for v in values] if totals else []),
    )
    out = local.join(offs, part, "inner")
    return out.select(
        *[field(c).alias(c) for c in cols],
        *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(f"{prefix}{v}") for v in values],
        *([F.col(f"tot_{v}") for v in values] if totals else []),
    )


def exact_quantile_frame(df: DataFrame, keys: Sequence[str], value: str,
                         extra_aggs: Sequence[tuple[str, Column]] = (),
                         slices: int | None = None,
                         count_nulls_as_rows: bool = False) -> DataFrame:
    """Distinct (keys, value) table with counts, cumulative counts and group
    totals: the input for exact interpolated quantiles, share-above-mean,
    MAD and std without ever collecting a group into one task.

    Columns: keys, value, _c (rows with that value), cum__c (rows <= value),
    tot__c (rows in the group), tot__cv and tot__cd (sum of value in the group,
    as ``EXACT`` and as double), tot__lossy (above 0: tot__cv lacks values that
    ``EXACT`` cannot hold), plus ``extra_aggs`` computed per (keys, value).  With ``count_nulls_as_rows``
    the null value keeps a row (``_c`` = 0) so ``extra_aggs`` see it.
    """
    keys = list(keys)
    src = df if count_nulls_as_rows else df.where(F.col(value).isNotNull())
    cv = (src.groupBy(*keys, value)
             .agg(F.count(value).alias("_c"), *[e.alias(n) for n, e in extra_aggs])
             .withColumn("_cv", F.coalesce(as_exact(value) * F.col("_c"), F.lit(0).cast(EXACT)))
             .withColumn("_cd", F.coalesce(F.col(value).cast("double") * F.col("_c"), F.lit(0.0)))
             .withColumn("_lossy", (F.col(value).isNotNull() & as_exact(value).isNull()).cast("int")))
    return running_sums(cv, [value], ["_c", "_cv", "_cd", "_lossy"], groups=keys, slices=slices, totals=True)


def quantile_at(value: str, q: float) -> Column:
    """Aggregate expression over an ``exact_quantile_frame`` giving the
    linearly interpolated quantile (numpy / quantile_cont semantics)."""
    n = F.col("tot__c")
    pos = F.lit(q) * (n - 1)
    lo = F.floor(pos)
    hi = F.ceil(pos)
    before = F.col("cum__c") - F.col("_c")          # 0-based rank of first copy
    last = F.col("cum__c") - 1                        # 0-based rank of last copy
    v_lo = F.max(F.when((before <= lo) & (lo <= last), F.col(value)))
    v_hi = F.max(F.when((before <= hi) & (hi <= last), F.col(value)))
    frac = F.max(pos - lo)
    return v_lo + (v_hi - v_lo) * frac
