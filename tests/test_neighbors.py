"""Exact kNN on clustered points (a hot cell, sparse outliers) against
brute force; several grid rounds are needed for the outliers."""
import numpy as np
import pandas as pd

from tessera.operators import neighbors as N


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    hot = rng.normal(0, 0.01, size=(300, 2))                    # a third of the points in one spot
    rest = rng.uniform(-5, 5, size=(600, 2))
    far = np.array([[40.0, 40.0], [-30.0, 25.0]])                 # isolated queries
    pts = np.vstack([hot, rest, far])
    pdf = pd.DataFrame({"id": np.arange(len(pts)), "x": pts[:, 0], "y": pts[:, 1]})
    df = spark.createDataFrame(pdf)
    ref = df.withColumnRenamed("id", "rid")
    k = 4
    out = N.knn(df, ref, "id", "rid", ["x", "y"], k,
                lambda a, b: N.euclid([a.x, a.y], [b.x, b.y]), exclude_self=True).toPandas()
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    exp = np.argsort(d, axis=1, kind="stable")[:, :k]
    got = out.sort_values(["id", "rank"]).groupby("id")["rid"].apply(list)
    assert len(got) == len(pts)
    for i in range(len(pts)):
        assert np.allclose(sorted(d[i, got[i]]), sorted(d[i, exp[i]]))
