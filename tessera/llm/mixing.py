"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule, a piecewise linear function of training
time in [0, 1].  Its integral is the source's share of the token budget.
The documents of a source form a stream (hash order, repeated as often as
the target asks); the integrated schedule is the source's cumulative demand,
and inverting it at a document's offset in the stream gives the training
position of that copy.  ``mix_documents`` range-sorts by position.

Targets are shared by weight and stop at ``max_repeats`` times the source's
size; the excess goes to the other sources by weight until none is above.
Whole documents are taken: all of them floor(target / size) times and, in
hash order, once more up to the fraction that is left, so a source's total
misses its target by half of one document at most.

Scale: offsets are two-level running sums (hash buckets of about
``BUCKET_ROWS`` rows, then a window over bucket totals), so a source with a
third of all rows is spread over many tasks.  Only one row per source and
bucket leaves the scan; the global order of the sources' names is taken on
one row per source.

Defined results: null text has size 0; the null source comes last; documents
of size 0 are taken ``copies`` times with no words; a source of size 0 has
target 0 and is not taken; equal ids are told apart by nothing, so repeated
rows are taken as neighbours in the stream; other columns are kept by
``mix_documents`` and ignored by ``mix_plan``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

BUCKET_ROWS = 2_000
#: Schedules given to the sources in turn: knots (time, weight); the
#: integrals are 1, 2 and 3.
CYCLE = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 3.0), (1.0, 1.0)), ((0.0, 2.0), (1.0, 4.0)))
WORD = r"[^\x20\x09-\x0D]+"


def integral(knots: Sequence[tuple[float, float]]) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def invert_schedule(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the schedule's integral has reached ``share`` (0 to 1)
    of its whole: the root of a quadratic within one piece."""
    whole, done, out = integral(knots), 0.0, None
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        need = share * F.lit(whole) - F.lit(done)
        slope = (w1 - w0) / (t1 - t0) if t1 > t0 else 0.0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * need, F.lit(0.0)))
        at = F.lit(t0) + F.coalesce(F.try_divide(2 * need, F.lit(w0) + root), F.lit(0.0))
        done += area
        here = F.greatest(F.lit(t0), F.least(F.lit(t1), at))
        out = F.when(share * F.lit(whole) <= F.lit(done), here) if out is None else out.when(
            share * F.lit(whole) <= F.lit(done), here)
    return out.otherwise(F.lit(float(knots[-1][0])))


def source_targets(sizes: DataFrame, cycle=CYCLE, max_repeats: int = 3, budget: float = 1.0) -> DataFrame:
    """(source, source_size) -> + rank, weight, target."""
    w = F.element_at(F.array(*[F.lit(integral(k)) for k in cycle]), (F.pmod(F.col("rank") - 1, F.lit(len(cycle))) + 1)
                     .cast("int"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", w)
    every = Window.partitionBy()
    # fill up: sources in the order in which they reach their limit
    turn = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(max_repeats)
    left = (F.sum("source_size").over(every) * F.lit(budget) - F.coalesce(F.sum(cap).over(turn), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(turn), F.lit(0.0)))
    return (ranked.withColumn("_level", left).withColumn("_level", F.max("_level").over(every))
            .withColumn("target", F.least(F.col("_level") * F.col("weight"), cap.cast("double"))).drop("_level"))


def mix_plan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             cycle=CYCLE, max_repeats: int = 3, budget: float = 1.0, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    copies, taken (= copies * size), positions (training time of each copy,
    in [0, 1]), and ``row`` (a struct of the columns in ``keep``)."""
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    hashed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.unhex(F.md5(key)).alias("_h"),
        F.floor(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2 ** 32))
        .cast("long").alias("_bucket"),
        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []))
    hashed = hashed.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
    sums = stage_table(hashed.groupBy("source", "_null", "_name", "_bucket").agg(F.sum("size").alias("_sum")), "sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), cycle, max_repeats,
                             budget)
    targets = targets.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
    before = Window.partitionBy("_null", "_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_null", "_name", "_bucket",
                          F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.join(targets.drop("source"), ["_null", "_name"])
    inside = (Window.partitionBy("_null", "_name", "_bucket").orderBy("_h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = hashed.join(offsets, ["_null", "_name", "_bucket"]).withColumn(
        "_start", F.col("_offset") + F.sum("size").over(inside) - F.col("size"))
    passes = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    more = (2 * F.col("_start") + F.col("size") < 2 * rest).cast("long")
    planned = at.withColumn("copies", (passes + more).cast("long"))

    def when(copy):
        share = F.try_divide((copy * F.col("source_size") + F.col("_start")).cast("double"), F.col("target"))
        turn = F.pmod(F.col("rank") - 1, F.lit(len(cycle)))
        out = None
        for k, knots in enumerate(cycle):
            out = (F if out is None else out).when(turn == k, invert_schedule(F.least(share, F.lit(1.0)), knots))
        return F.coalesce(out, F.lit(0.0))
    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), when)).otherwise(
        F.array().cast("array<double>"))
    return planned.select("doc_id", "source", "size", "source_size", "target", "copies",
                          (F.col("copies") * F.col("size")).alias("taken"), positions.alias("positions"),
                          *(["row"] if keep else []))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (same columns) as the mix takes them: a row for each copy,
    range-sorted by training position; documents taken no time are left out."""
    cols = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)])
    names = {k: f"_c{cols.index(options.pop(k, k))}" for k in ("doc_id", "text", "source")}
    plan = mix_plan(named, **names, keep=named.columns, **options)
    copies = plan.select(F.explode("positions").alias("_at"), "doc_id", "row")
    return (copies.repartitionByRange(F.col("_at"), F.col("doc_id")).sortWithinPartitions("_at", "doc_id")
            .select(*[F.col("row").getField(f"_c{i}").alias(c) for i, c in enumerate(cols)]))
