import zlib

import numpy as np

from tessera.llm import toxicity as X
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def auc(pos, neg):
    return np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])


def test_query_on_rows_held_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.7) for i, r in rows.items())
    out = [(rows[i].score, y) for i, y in labels.items() if i in rows and rows[i].held_out]
    pos, neg = [s for s, y in out if y], [s for s, y in out if not y]
    assert auc(pos, neg) > 0.97
    assert np.mean([s >= 0.7 for s in pos]) > 0.5 and np.mean([s >= 0.7 for s in neg]) < 0.005


def test_gradient_step_against_the_formula():
    m = X.Ftrl(np.zeros(3), np.zeros(3), 0.5, 1.0, 0.1, 0.2)
    z, n, w = [0.0] * 3, [0.0] * 3, [0.0] * 3
    for at, y in (([0, 2], 1), ([0, 1], 0), ([0, 2], 1), ([1], 1)):
        p = 1 / (1 + np.exp(-sum(w[i] for i in at)))
        for i in at:
            g = p - y
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[i]
            n[i] += g * g
        w = [0.0 if abs(a) <= 0.1 else -(a - np.sign(a) * 0.1) / ((1 + b ** 0.5) / 0.5 + 0.2) for a, b in zip(z, n)]
        m.learn(np.array(at), y)
    assert np.allclose(m.weights(), w) and np.any(np.array(w) != 0)


def test_edges(small, docs_of):
    texts = {i: ("you vile fool " if i % 4 == 0 else "fine words here ") + f"w{i % 7} " * 20 for i in range(80)}
    docs = docs_of(texts | {100: None, 101: "", 102: "vile fool " + "x" * 200000}).withColumnRenamed("lang", "_score")
    labels = small([(i, int(i % 4 == 0)) for i in range(80)] + [(3, None), (None, 1), (500, 1), (4, 1)],
                   "doc_id long, toxic int")
    from pyspark.sql import functions as F
    w = X.train(X.training_sample(docs, labels, label="toxic", usable=F.lit(True)))
    got = {r.doc_id: r for r in X.score(docs, w).collect()}
    assert min(got[i].score for i in range(0, 80, 4)) > max(got[i].score for i in range(80) if i % 4)
    assert got[100].score == got[101].score <= 0.5 < got[102].score and got[5]["_score"] == "en"
    none = X.train(X.training_sample(docs, labels.limit(0), label="toxic", usable=F.lit(True)))
    assert {r.score for r in X.score(docs, none).collect()} == {0.5}
    assert X.score(docs.limit(0), w).collect() == []
    again = X.train(X.training_sample(docs, labels, label="toxic", usable=F.lit(True)))
    assert np.array_equal(w, again)
