"""Exact vector neighbours by rings around pivots, and nan-Euclidean
imputation, against brute force."""
import numpy as np
import pandas as pd
import pytest

from tessera.operators import vectors as V


def _brute(q, r, k, dist, self_=False):
    out = {}
    for i, (g, a) in q.items():
        found = sorted((d, j) for j, (h, b) in r.items() if h == g and not (self_ and i == j)
                       for d in [dist(a, b)] if d is not None)
        out[i] = found[:k]
    return out


def _euclid(a, b):
    return float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum()))


def _nan(a, b):
    both = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    return float(np.sqrt(len(a) / len(both) * sum((x - y) ** 2 for x, y in both))) if both else None


def _check(got, want, k):
    seen = {}
    for row in sorted(got, key=lambda x: (x["q"], x["rank"])):
        seen.setdefault(row["q"], []).append((row["distance"], row["r"]))
    for i, w in want.items():
        own = seen.get(i, [])
        assert [j for _, j in own] == [j for _, j in w]
        assert [d for d, _ in own] == pytest.approx([d for d, _ in w])
    assert set(seen) <= set(want)


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(V, "PART", 40)
    monkeypatch.setattr(V, "VISITS", 15)


@pytest.mark.parametrize("dim, k", [(2, 3), (24, 5)])
def test_knn_in_groups_with_a_hot_cell(spark, small_parts, dim, k):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(260, dim))
    x[:110] = x[0] + 1e-3 * rng.normal(size=(110, dim))     # a dense cluster
    x[110:114] = x[114]                                   # copies
    rows = {i: (int(i % 3 == 0), [float(v) for v in x[i]]) for i in range(260)}
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in rows.items()] + [(999, 0, None), (998, 1, [None] * dim)],
                               "q int, g int, v array<double>")
    got = V.knn_vectors(df, df.withColumnRenamed("q", "r"), k, qid="q", rid="r", vector="v", by=["g"], pivots=6,
                        exclude_self=True).collect()
    _check(got, _brute(rows, rows, k, _euclid, True), k)


def test_fewer_references_than_k_and_none(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, [5.0, 5.0])], "q int, v array<double>")
    r = spark.createDataFrame([(7, [1.0, 0.0]), (8, [4.0, 5.0])], "r int, v array<double>")
    got = V.knn_vectors(q, r, 5, qid="q", rid="r", vector="v").collect()
    assert sorted((x["q"], x["rank"], x["r"]) for x in got) == [(1, 1, 7), (1, 2, 8), (2, 1, 8), (2, 2, 7)]
    none = V.knn_vectors(q, r.limit(0), 5, qid="q", rid="r", vector="v")
    assert none.columns == ["q", "r", "distance", "rank"] and none.collect() == []


def test_nan_euclidean_imputation(spark, small_parts):
    rng = np.random.default_rng(1)
    x = [[None if rng.random() < 0.3 else float(v) for v in row] for row in rng.normal(size=(120, 4))]
    x[5] = [None] * 4                                     # nothing shared with anyone
    x[6], x[7] = [None, 1.0, 1.0, 1.0], [0.5, 1.0, 1.0, 1.0]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(x)], "id int, a double, b double, c double, d double")
    fills = {"m": ("mean", 3), "w": ("distance", 4), "md": ("median", 7)}
    got = {r["id"]: r for r in V.nan_knn_impute(df, "id", list("abcd"), "a", fills).collect()}
    known = {i: (0, row) for i, row in enumerate(x) if row[0] is not None}
    near = _brute({i: (0, row) for i, row in enumerate(x) if row[0] is None}, known, 7, _nan)
    mean = np.mean([row[0] for _, row in known.values()])
    assert set(got) == set(near) and got[5]["m"] == pytest.approx(mean) and got[6]["w"] == 0.5
    for i, found in near.items():
        if found:
            v, d = np.array([known[j][1][0] for _, j in found]), np.array([d for d, _ in found])
            assert got[i]["m"] == pytest.approx(v[:3].mean()) and got[i]["md"] == pytest.approx(np.median(v))
            if d[0] > 0:
                assert got[i]["w"] == pytest.approx((v[:4] / d[:4]).sum() / (1 / d[:4]).sum())


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_blocks_of_queries_find_what_one_by_one_finds(shift):
    rng = np.random.default_rng(3)
    m, v = rng.normal(size=(700, 6)) + shift, rng.normal(size=(300, 6)) + shift
    m[100:140] = m[0]                                        # ties go to the smaller id
    v[5] = m[0]
    pivot = m[7]
    b = pd.DataFrame({"r": rng.permutation(700), "v": list(m), "ring": np.sqrt(((m - pivot) ** 2).sum(axis=1))})
    a = pd.DataFrame({"q": np.arange(300), "g": 0, "v": list(v), "ring": np.sqrt(((v - pivot) ** 2).sum(axis=1)),
                      "bound": np.where(np.arange(300) % 3 == 0, np.inf, 1.5)})
    got = pd.concat(V._near(a, b, 4, True))
    ids, want = b["r"].to_numpy(), []
    for q, x, bound in zip(a["q"], v, a["bound"]):
        d = np.sqrt(((m - x) ** 2).sum(axis=1))
        at = np.flatnonzero((d <= bound) & (ids != q))
        want += [(q, ids[i], d[i]) for i in at[np.lexsort((ids[at], d[at]))[:4]]]
    assert sorted(zip(got["q"], got["r"], got["distance"])) == sorted(want)
