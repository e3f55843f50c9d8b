"""Values that end a job or bend a result: tiny and huge magnitudes, large
ids, zeros, constants, one class, all nulls, far queries, growing folders."""
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import aggregates as A
from tessera.operators import ensemble as E
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators import neighbors as N
from tessera.operators import quality as Q
from tessera.operators import windows as W
from tessera.operators.prefix import range_slices, running_sums


def test_a_folder_that_grows_is_read_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1, 21).selectExpr("id", "1L AS one").write.parquet(path)
    first = running_sums(spark.read.parquet(path), ["id"], ["one"], slices=4)
    assert first.agg(F.max("cum_one")).first()[0] == 20
    spark.range(21, 31).selectExpr("id", "1L AS one").write.mode("append").parquet(path)
    again = running_sums(spark.read.parquet(path), ["id"], ["one"], slices=4)
    assert again.agg(F.max("cum_one"), F.count("*")).first()[:] == (30, 30)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_rows_move_once_in_running_sums(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000).selectExpr("id % 7 AS g", "id AS t", "1.5D AS v").write.parquet(path)
    out = running_sums(spark.read.parquet(path), ["t"], ["v"], groups=["g"], slices=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    big = [x for x in plan.splitlines() if "Exchange hashpartitioning(_slice" in x]
    assert "rangepartitioning" not in plan and 1 <= len(big) <= 2        # the rows, and one row per slice


@pytest.mark.parametrize("desc", [False, True])
def test_slices_follow_the_order_with_nulls_and_nan(spark, desc):
    vals = [None, float("nan"), float("-inf"), float("inf"), 0.0, -0.0, 1e-300] + [float(i) for i in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals * 20)], "id long, v double")
    order = [("v", "desc") if desc else "v", "id"]
    got = running_sums(df.withColumn("one", F.lit(1)), order, ["one"], slices=9).select("id", "cum_one").collect()
    want = [r["id"] for r in df.orderBy(F.desc("v") if desc else F.asc("v"), "id").collect()]
    assert [r["id"] for r in sorted(got, key=lambda r: r["cum_one"])] == want
    assert sorted(r["cum_one"] for r in got) == list(range(1, len(want) + 1))


def test_slices_by_text_date_and_decimal(spark):
    df = spark.range(300).selectExpr("id", "concat('k', id % 13) AS s", "date_add(DATE'2020-01-01', int(id % 50)) AS d",
                                     "CAST(id % 9 AS decimal(9,2)) AS x", "1 AS one")
    for o in ("s", "d", "x"):
        got = running_sums(df, [o, "id"], ["one"], slices=5).select("id", "cum_one").collect()
        assert [r["id"] for r in sorted(got, key=lambda r: r[1])] == [r[0] for r in df.orderBy(o, "id").collect()]
        ranged = range_slices(df, [], [o, "id"], slices=5)[0]
        assert ranged.select("_slice").distinct().count() == 5


def test_empty_table(spark):
    df = spark.createDataFrame([], "g long, t long, v double")
    assert running_sums(df, ["t"], ["v"], groups=["g"]).count() == 0


def test_panel_summary_of_tiny_and_huge_values(spark):
    tiny = [i * 1e-7 for i in range(1, 6)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(tiny)] + [(2, 0, 1e33), (2, 1, 3e33)]
                               + [(3, 0, None), (3, 1, None)], "k long, t long, v double")
    out = {r["k"]: r for r in A.panel_summary(df, "k", "v", ["t"]).collect()}
    assert math.isclose(out[1]["mean"], 3e-7) and math.isclose(out[1]["std"], 1.5811388e-7, rel_tol=1e-6)
    assert out[1]["count_above_mean"] == 2 and math.isclose(out[1]["mad"], 1.2e-7)
    assert math.isclose(out[2]["mean"], 2e33) and out[2]["count_above_mean"] == 1
    assert out[3]["n"] == 0 and out[3]["mean"] is None and out[3]["mad"] is None


def test_last_with_large_ids(spark):
    df = spark.createDataFrame([(1, 9 * 10 ** 18, 1, 5.0), (1, 1, 2, 7.0)], "k long, id long, s long, v double") \
        .withColumn("t", F.timestamp_micros("s"))
    assert A.panel_summary(df, "k", "v", ["t", "id"]).first()["last"] == 7.0


def test_level_shift_with_a_zero_in_one_series(spark):
    rows = [(k, t, 0.0 if (k, t) == (1, 2) else 10.0 + (t == 6) * 9) for k in (1, 2) for t in range(8)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    out = {(r["k"], r["t"]): r["o"] for r in W.level_shift_repair(df, "k", ["t"], "v", "o").collect()}
    alone = W.level_shift_repair(df.where("k = 2"), "k", ["t"], "v", "o").collect()
    assert len(out) == 16 and all(math.isclose(out[2, r["t"]], r["o"]) for r in alone)


def test_row_stats_of_nulls(spark):
    df = spark.createDataFrame([(None, None), (1.0, 3.0)], "a double, b double")
    s = A.row_stats(["a", "b"])
    got = [tuple(r) for r in df.select(*[s[k].alias(k) for k in s]).collect()]
    assert (None,) * 4 in got and (2.0, 1.0, 1.0, 3.0) in got


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert df.select(W.zscore(df, "v"), W.minmax_rescale(df, "v")).first()[:] == (None, None)


def test_single_class_group(spark):
    rows = [("a", 1, 1, 0.2), ("a", 2, 0, 0.1), ("b", 3, 0, 0.5), ("b", 4, 0, 0.6), ("c", 5, 1, 0.5)]
    df = spark.createDataFrame(rows, "g string, id long, y int, p double")
    assert {r["g"]: r["auc"] for r in M.roc_auc(df, "y", "p", by=["g"]).collect()} == {"a": 1.0, "b": None, "c": None}
    assert M.amex_metric(df, "y", "p", "id", by=["g"]).count() == 3
    assert M.roc_cutoff(df, "y", "p", by=["g"]).count() == 3
    M.pr_cutoff(df, "y", "p", by=["g"]).collect()
    M.quadratic_kappa(df, "y", "y", by=["g"]).collect()


def test_zero_prediction_in_a_blend(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.5), (2, 0.5), (2, 0.5)], "id long, pred double")
    out = {r["id"]: r for r in E.mean_blend(df, "id").collect()}
    assert out[1]["hmean"] == 0.0 and out[1]["gmean"] == 0.0 and math.isclose(out[2]["hmean"], 0.5)


TEXTS = ["\nfoo bar", "foo\t", "", "  ", "a b c", "x\x1cy\x85z", "one  two\r\n three"]


def test_words_are_python_split(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert [r[0] for r in df.select(X.words("t")).collect()] == [t.split() for t in TEXTS]


def test_cleaner_keeps_what_a_cut_url_leaves(spark):
    df = spark.createDataFrame([("http@abc fire",), ("see http://x.y#z now",)], "t string")
    assert [r[0] for r in df.select(X.clean_text("t")).collect()] == ["http fire", "see"]


def test_describe_keeps_a_column_of_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    out = {r["column"]: r for r in Q.describe(df, ["a", "b"]).collect()}
    assert out["b"]["count"] == 0 and out["b"]["mean"] is None and out["a"]["p50"] == 1.5


def test_far_query_gets_its_neighbours(spark):
    ref = spark.createDataFrame([(i, (i % 10) / 10, (i // 10) / 10) for i in range(100)], "rid long, x double, y double")
    q = spark.createDataFrame([(1, 0.51, 0.5), (2, 1e6, 1e6)], "qid long, x double, y double")
    out = {r["qid"]: r["rid"] for r in N.nearest(q, ref, "qid", "rid", ["x", "y"]).collect()}
    assert out == {1: 55, 2: 99}


def test_imputation_keeps_rows_with_a_null_feature(spark):
    rows = [(1, 0.0, 1.0), (2, 1.0, 3.0), (3, None, None), (4, 0.1, None)]
    df = spark.createDataFrame(rows, "id long, x double, v double")
    out = {r["id"]: r["imputed"] for r in N.knn_impute(df, "id", "v", ["x"], 1).collect()}
    assert out == {3: None, 4: 1.0}


def test_as_of_takes_a_null_value(spark):
    probe = spark.createDataFrame([(1,), (5,)], "k long")
    ref = spark.createDataFrame([(2, None), (6, 7.0)], "k long, v double")
    assert {r["k"]: r["o"] for r in J.asof_next(probe, ref, "k", "v", "o").collect()} == {1: None, 5: 7.0}
