"""Closed-form metric checks."""
import math

from pyspark.sql import functions as F

from tessera.operators import ensemble as E
from tessera.operators import metrics as M


def _scored(spark):
    rows = [(i, 1 if i % 3 == 0 else 0, (i % 7) / 7.0) for i in range(60)]
    return spark.createDataFrame(rows, "id long, y int, p double")


def test_amex_perfect_ranking_is_one(spark):
    df = _scored(spark).withColumn("p", F.col("y").cast("double"))
    r = M.amex_metric(df, "y", "p", "id").first()
    assert math.isclose(r["norm_gini"], 1.0) and r["amex"] <= 1.0


def test_smape_of_equal_vectors_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (3.0, 3.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert r["smape"] == 0.0 and r["rmse"] == 0.0


def test_auc_complement(spark):
    df = _scored(spark)
    a = M.roc_auc(df, "y", "p").first()["auc"]
    b = M.roc_auc(df.withColumn("p", 1 - F.col("p")), "y", "p").first()["auc"]
    assert math.isclose(a + b, 1.0)


def test_kappa_identity_is_one(spark):
    df = spark.createDataFrame([(i % 5, i % 5) for i in range(50)], "y int, p int")
    assert math.isclose(M.quadratic_kappa(df, "y", "p").first()["qwk"], 1.0)


def test_least_squares_weights_recover_blend(spark):
    rows = [(float(i), float((i * 7) % 11), 0.3 * i + 0.7 * ((i * 7) % 11)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    w = E.least_squares_weights(df, "y", ["a", "b"])
    assert math.isclose(w["a"], 0.3, abs_tol=1e-9) and math.isclose(w["b"], 0.7, abs_tol=1e-9)
