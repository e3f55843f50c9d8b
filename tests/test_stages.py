"""Operators with many passes run what leads to their rows once."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import models as K
from tessera.operators import select as L
from tessera.operators import trees as T


@pytest.fixture
def counted(spark):
    """A table of 300 rows and how often its rows have been made."""
    made = spark.sparkContext.accumulator(0)

    def make(frames):
        for f in frames:
            made.add(len(f))
            yield f
    df = spark.range(300).select("id", (F.col("id") % 17 / 4).alias("a"), (F.col("id") % 23 / 7 + F.col("id") / 1000).alias("b"),
                                 (F.col("id") % 3 == 0).cast("double").alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    return df.mapInPandas(make, df.schema), made


def test_grid_search_deals_folds_once(counted):
    df, made = counted
    got = K.grid_search(df, ["a", "b"], "y", "fold", [0.0, 0.1], [0.0, 1.0])
    assert len(got) == 4 and made.value == 300


def test_trees_read_their_source_once(counted):
    df, made = counted
    T.grow(df, [T.Group("g", ("a", "b"), "y", 3)], depth=3)
    assert made.value == 300


def test_permutation_importance_by_steps_is_that_by_join(counted, monkeypatch):
    df, made = counted

    def predict(x):
        return 1 / (1 + np.exp(-(x @ np.array([0.5, -0.25]))))

    def loss(y, p):
        return (y - p) ** 2
    by_steps = L.permutation_importance(df, ["a", "b"], "y", "id", predict, loss, repeats=4).collect()
    assert made.value == 300
    monkeypatch.setattr(L, "STEP_LEVELS", 2)
    monkeypatch.setattr("tessera.operators.permute.MAX_LEVELS", 2)
    by_join = L.permutation_importance(df, ["a", "b"], "y", "id", predict, loss, repeats=4).collect()
    for r, s in zip(sorted(by_steps), sorted(by_join)):
        assert r[0] == s[0] and r[1:] == pytest.approx(s[1:], abs=1e-12)


def test_segments_are_solved_without_a_call_each(spark):
    df = spark.createDataFrame([(k, float(x), 2.0 * k + 3.0 * x) for k in (1, 2) for x in range(4)], "k long, x double, y double")
    fits = K.segment_ridge(df, ["k"], [F.col("x")], ["slope"], "y")
    assert "FlatMapGroupsInPandas" not in fits._jdf.queryExecution().executedPlan().toString()
    for r in fits.collect():
        assert r["intercept"] == pytest.approx(2.0 * r["k"]) and r["slope"] == pytest.approx(3.0)


def test_grid_rounds_rank_their_candidates_once(counted, spark):
    df, made = counted
    from tessera.operators import neighbors as N
    far = spark.createDataFrame([(1000, 40.0, 40.0), (1001, 2.0, 3.0)], "id long, a double, b double")
    got = N.nearest(far, df.select(F.col("id").alias("rid"), "a", "b"), "id", "rid", ["a", "b"])
    rounds = got._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    got.collect()
    # extent, densest cell, and one pass a round
    assert made.value <= 300 * (2 + max(rounds, 1))


def test_queries_of_one_file_are_dealt_to_tasks(spark, monkeypatch):
    from tessera.operators import neighbors as N
    monkeypatch.setattr(N, "TASK_CANDIDATES", 400)
    seen = []
    real = N.stage_rows
    monkeypatch.setattr(N, "stage_rows", lambda df, name: seen.append(df.rdd.getNumPartitions()) or real(df, name))
    q = spark.range(0, 200, 1, 1).select("id", (F.col("id") % 13).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    got = N.nearest(q, q.withColumnRenamed("id", "rid"), "id", "rid", ["a", "b"])
    assert got.count() == 200 and got.where("distance > 0").count() == 0 and seen[0] > 1


def test_out_of_fold_means_deal_folds_once(counted):
    from tessera.operators import validate as V
    df, made = counted
    got = V.out_of_fold_group_mean(df.withColumn("g", F.col("id") % 4), "fold", "g", "b")
    assert got.count() == 300 and made.value == 300


def test_walk_forward_keeps_one_row_a_key_and_cut(spark):
    from tessera.operators import validate as V
    rows = [("a", p, float(p)) for p in (1, 2, 5, 9)] + [("b", p, 10.0 * p) for p in (3, 4)] + [(None, 2, 1.0), (None, 3, 2.0), ("a", None, 7.0)]
    df = spark.createDataFrame(rows, "k string, p int, v double")
    every = V.walk_forward(df, "p", 2, 8).where("role = 'train'").groupBy("k", "cut").agg(F.max_by("v", "p").alias("v"))
    last = V.walk_forward(df, "p", 2, 8, last_of=["k"]).where("role = 'train'").select("k", "cut", "v")
    assert sorted(map(str, last.collect())) == sorted(map(str, every.collect()))
    assert V.walk_forward(df, "p", 2, 8, last_of=["k"]).where("role = 'test'").count() == V.walk_forward(df, "p", 2, 8).where("role = 'test'").count()


def test_stacking_scores_each_line_once(spark, tmp_path, monkeypatch):
    from tessera import session
    from tessera.plans import REGISTRY
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    li.unionByName(li).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen = {}
    real = session.stage_rows
    monkeypatch.setattr(session, "stage_rows", lambda df, name: seen.setdefault(name, real(df, name)))
    REGISTRY["e14_stacking"].build(spark, str(tmp_path))
    assert seen["stacking"].count() == 2 * li.count()


def test_source_forest_reads_its_rows_once(counted):
    df, made = counted
    K.adversarial_auc(df.where("fold < 2"), df.where("fold = 2"), ["a", "b"], "id")
    assert made.value == 600                                  # each source once
