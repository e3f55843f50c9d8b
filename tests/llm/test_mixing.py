import duckdb
import pytest

from tessera.llm import mixing as M
from tessera.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


def against_sql(spark, d, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    cur = con.execute(SQL[key])
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=str)
    return sorted((tuple(r) for r in QUERIES[key](spark, d).select(*names).collect()), key=str), want


@pytest.mark.parametrize("d", [SF, "/root/testdata/sf0.001"])
def test_query_against_sql(spark, d):
    got, want = against_sql(spark, d, "op4_mix")
    assert got == want


def test_totals_limits_and_edges(small, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 7)
    rows = [(i, "w " * (i % 9 + 1), "en", f"s{i % 4}" if i % 5 else None, 0) for i in range(200)]
    rows += [(900, None, "en", "empty", 0), (901, "a b", "en", "tiny", 0), (901, "a b", "en", "tiny", 0)]
    docs = small(rows).withColumnRenamed("lang", "target")
    got = M.mix_plan(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.taken == r.copies * r["size"] <= 3 * r["size"] and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        t = by.setdefault(r.source, [0, r.target, r.source_size])
        t[0] += r.taken
    assert all(abs(a - b) <= 5 for a, b, _ in by.values())
    assert abs(sum(b for _, b, _ in by.values()) - sum(s for _, _, s in by.values())) < 1e-6
    assert by["tiny"][:2] == [12, 12.0] and by["empty"][:2] == [0, 0.0]
    mixed = M.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in got for _ in r.positions)
    assert M.mix_plan(docs.limit(0)).collect() == [] and M.mix_documents(docs.limit(0)).collect() == []


def test_inverse_of_the_schedule(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))
    from pyspark.sql import functions as F
    df = spark.range(101).select((F.col("id") / 100).alias("y"))
    whole = M.integral(knots)
    for r in df.select("y", M.invert_schedule(F.col("y"), knots).alias("t")).collect():
        area = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            x = min(max(r.t, t0), t1)
            area += (x - t0) * (w0 + w0 + (w1 - w0) * (x - t0) / (t1 - t0)) / 2
        assert abs(area / whole - r.y) < 1e-9
