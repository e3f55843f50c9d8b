import numpy as np
import pytest
from pyspark.sql import functions as F

from test_mixing import against_sql
from tessera.llm import vptree as V

SF = "/root/testdata/sf0.01"


def test_query_against_sql(spark):
    got, want = against_sql(spark, SF, "op9_neighbours")
    assert got == want and len(got) == 50


@pytest.mark.parametrize("shard", [40, 2000])
def test_shards_ties_and_edges(small, monkeypatch, shard):
    monkeypatch.setattr(V, "SHARD_ROWS", shard)
    monkeypatch.setattr(V, "QUERY_BLOCK", 7)
    monkeypatch.setattr(V, "LEAF", 8)
    rng = np.random.RandomState(2)
    centres = rng.randn(6, 8)
    rows = [(i, [float(x) for x in centres[i % 6] + rng.randn(8) * 0.3]) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0] + [0.0] * 6) for i in range(60)]               # one common vector
    bad = [(900, None), (910, [0.0] * 8), (920, [1.0, None] + [0.0] * 6), (930, [float("nan")] * 8),
           (940, [float("inf")] * 8), (None, [1.0] * 8), (950, [3.0])]
    df = small(rows + bad, "vec_id long, embedding array<double>")
    got = V.nearest(df.withColumn("pivot", F.lit("x")), F.col("id") % 10 == 0, k=5).collect()
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    want = []
    for i, v in rows:
        if i % 10 == 0:
            s = V.exact_scores(np.array([v]), x)[0]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:5]
            want += [(i, r + 1, int(ids[j]), float(s[j])) for r, j in enumerate(order)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    loose = V.nearest(df, F.col("id") % 10 == 0, k=5, factor=1.5).collect()
    hit = {(r.query_id, r.vec_id) for r in loose} & {(w[0], w[2]) for w in want}
    assert len(hit) >= 0.9 * len(want)
    few = V.nearest(df.where("vec_id < 3"), F.lit(True), k=5).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert V.nearest(df.limit(0), F.lit(True)).collect() == []
