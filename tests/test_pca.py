"""Out-of-fold principal components against numpy."""
import numpy as np
import pytest

from tessera.operators import prep as X


def test_out_of_fold_scores_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) + 7
    rows = [(i, i % 3, [float(v) for v in x[i]]) for i in range(200)]
    df = spark.createDataFrame(rows + [(900, 1, None), (901, None, [1.0] * 6), (902, 2, [None] * 6)],
                               "id int, fold int, v array<double>").repartition(5)
    scored, fits = X.out_of_fold_pca(df, "v", "fold", 4)
    got = {r["id"]: r["scores"] for r in scored.collect()}
    assert got[900] is got[901] is got[902] is None and len(got) == 203
    fold = np.arange(200) % 3
    for f in range(3):
        train = x[fold != f]
        n, mean, var, axes = fits[f]
        assert n == len(train) and mean == pytest.approx(train.mean(axis=0))
        s = np.linalg.svd(train - train.mean(axis=0), full_matrices=False)
        assert var == pytest.approx(s[1] ** 2 / len(train), abs=1e-8)
        want = (x[fold == f] - train.mean(axis=0)) @ s[2].T[:, :4]
        own = np.array([got[i] for i in range(200) if i % 3 == f])
        assert np.abs(own) == pytest.approx(np.abs(want), abs=1e-6)


def test_moments_do_not_depend_on_the_partitioning(spark):
    df = spark.range(60).selectExpr("cast(id % 2 as int) as f", "array(cast(id as float), cast(id * id as float)) as v")
    a, b = X.fold_moments(df.repartition(7), "v", "f"), X.fold_moments(df.coalesce(1), "v", "f")
    assert set(a) == {0, 1} and all(np.allclose(a[k], b[k]) for k in a) and a[0][0, 0] == 30
