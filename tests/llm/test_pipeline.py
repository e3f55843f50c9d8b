"""Every stage against a brute-force version on the rows it was given."""
import collections
import re

import corpus_pipeline as P
import test_decontaminate
import test_jaccard
import test_tokens
from tessera.llm import toxicity
from tessera.llm.common import stage_table
from tessera.llm.queries import toxicity_weights

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(P.STAGES)
    # toxicity
    out = stage_table(stages["toxicity"](spark, docs, SF), "t")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_weights(docs, spark, SF)).collect()
    assert rows(out) == sorted((tuple(r) for r in docs.collect() if r.doc_id in
                                {s.doc_id for s in scored if s.score < 0.7}), key=str)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in out.collect()}
    assert sum(labels[i] == 0 and i not in kept for i in labels) == 0
    # near duplicates
    src, out = out, stage_table(stages["near_duplicates"](spark, out, SF), "t")
    want = {i for i, _, c in test_jaccard.brute([(r.doc_id, r.text) for r in src.collect()], 5, 80) if i == c}
    assert rows(out) == sorted((tuple(r) for r in src.collect() if r.doc_id in want), key=str)
    # decontamination
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    src, out = out, stage_table(stages["decontamination"](spark, out, SF), "t")
    hits = {r[0]: r for r in test_decontaminate.brute([(r.doc_id, r.text) for r in src.collect()], items)}
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {i for i, h in hits.items() if h[2] <= h[1] / 2}
    for r in src.collect():
        if r.doc_id in got and not hits[r.doc_id][2]:
            assert got[r.doc_id] == r
    cut = [i for i in got if hits[i][2]]
    for i in cut:
        assert len(test_decontaminate.WORD.findall(test_decontaminate.low(got[i].text))) == hits[i][1] - hits[i][2]
    # mixing
    src, out = out, stage_table(stages["mixing"](spark, out, SF), "t")
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    by, took = collections.Counter(), collections.Counter()
    for r in src.collect():
        by[r.source] += size(r.text)
    for r in out.collect():
        took[r.source] += size(r.text)
    level = {s: 1 + k % 3 for k, s in enumerate(sorted(by))}
    left, pool = dict(by), sum(by.values())
    target = {}
    while True:                                       # share by weight, again and again
        lam = (pool - sum(target.values())) / sum(level[s] for s in left)
        full = [s for s in left if lam * level[s] > 3 * by[s]]
        if not full:
            break
        for s in full:
            target[s] = 3 * by[s]
            del left[s]
    target |= {s: lam * level[s] for s in left}
    largest = max(size(r.text) for r in src.collect())
    assert all(abs(took[s] - target[s]) <= largest / 2 for s in by) and set(rows(out)) <= set(rows(src))
    # tokens
    src, out = out, stages["tokens"](spark, out, SF)
    plain = test_tokens.brute([(r.doc_id, r.text) for r in src.collect()])
    assert sorted((r[0], r[2], r[3]) for r in out.collect()) == sorted((r[0], r[2], r[3]) for r in plain)
    assert sorted(r[1] for r in out.collect()) == sorted(r[1] for r in plain)


def test_stages_on_empty_tables_and_null_columns(spark, small):
    none = small([(1, None, None, None, None), (2, "", "en", None, 0), (3, None, None, "s", None),
                  (4, "one two three four five six", "en", None, 27), (5, "one two three four five six", None, "s", 27)])
    for docs, left in ((none, {1, 2, 3, 4}), (none.limit(0), set())):
        for k, (name, stage) in enumerate(P.STAGES):
            docs = stage(spark, docs, SF)
            if k < 2:
                docs = stage_table(docs, "t")
                assert {r.doc_id for r in docs.collect()} == (left | {5} if left and name == "toxicity" else left)
            elif k < 4:
                docs = stage_table(docs, "t")
                assert docs.columns == none.columns and {r.doc_id for r in docs.collect()} <= left
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert (docs.count() > 0) == bool(left)
