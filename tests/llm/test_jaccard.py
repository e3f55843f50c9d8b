import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import jaccard as J
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, n=3, percent=90):
    sets, post = [], {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(max(len(w) - n + 1, min(1, len(w))))))
        for x in sets[-1]:
            post.setdefault(x, []).append(len(sets) - 1)
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, s in enumerate(sets):
        near = {}
        for x in s:
            for b in post[x]:
                if b < a:
                    near[b] = near.get(b, 0) + 1
        for b, k in near.items():
            if 100 * k >= percent * (len(s) + len(sets[b]) - k):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[root(k)] = min(i, least.get(root(k), i))
    return sorted((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(docs))


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op3_jaccard"](spark, SF).collect())
    assert got == brute(docs) and any(a != c for a, _, c in got)


@pytest.mark.parametrize("seeds", [3, 0])
def test_chains_copies_and_edges(docs_of, monkeypatch, seeds):
    """With and without the grouping by min-hash: the matrix alone must find
    every link between classes."""
    if not seeds:
        monkeypatch.setattr(J, "_near_leaders", lambda docs, nodes, n, percent: nodes.selectExpr(
            "sig as a", "sig as b").limit(0))
    monkeypatch.setattr(J, "GROUP", 5)
    rnd = random.Random(5)
    vocab = [f"w{k}" for k in range(400)]
    texts, base = {}, [[rnd.choice(vocab) for _ in range(rnd.choice([8, 30, 60, 120]))] for _ in range(12)]
    for b in base:
        w = list(b)
        for _ in range(12):
            texts[len(texts)] = " ".join(w)
            if rnd.random() < 0.8:
                w[rnd.randrange(len(w))] = rnd.choice(vocab)       # a chain of near copies
    texts |= {500: None, 501: "", 502: " \n", 503: "One", 504: "one", 505: "one two", 506: "a b c", 507: "A b  c"}
    docs = docs_of(dict(rnd.sample(list(texts.items()), len(texts)))).withColumnRenamed("lang", "sig")
    got = sorted(tuple(r) for r in J.jaccard_components(docs).collect())
    assert got == brute(list(texts.items()))


def test_one_per_component(docs_of):
    docs = docs_of({1: None, 2: None, 3: "x y z w", 4: "X y z w", 5: "other words here"})
    docs = docs.union(docs.where("doc_id = 3"))
    kept = J.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5]
    assert J.jaccard_components(docs.limit(0)).collect() == []


def test_one_per_component_keeps_what_is_not_linked(small):
    """By row, not by id alone: null ids, ids shared by other texts, ids shared with empty texts."""
    a, b = "a text of its own about rivers", "some other words about high mountains"
    rows = [(None, "first words without an id"), (None, "second text that lacks one too"), (None, a), (None, None),
            (None, " "), (1, a), (5, a), (5, b), (7, "one clean text on trains"), (7, "one more about old ships"),
            (8, ""), (8, "words beside an empty row"), (9, "linked here"), (None, "linked here"), (9, "Linked here")]
    docs = small([(i, t, "en", "s", 0) for i, t in rows])
    got = sorted(((r.doc_id, r.text.lower() if r.text else r.text) for r in J.one_per_component(docs).collect()),
                 key=str)
    assert got == sorted([r for r in rows if r not in ((None, a), (5, a), (9, "linked here"), (None, "linked here"),
                                                       (9, "Linked here"))] + [(9, "linked here")], key=str)


def test_bit_maps_travel_only_with_nodes_that_a_candidate_names(docs_of, monkeypatch):
    kept, stage = {}, J.stage_table

    def note(df, name):
        kept[name] = stage(df, name)
        return kept[name]
    monkeypatch.setattr(J, "stage_table", note)
    word = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    docs = {k: word(k, 40) for k in range(60)} | {100: f"{word(99, 60)} a b", 101: f"{word(99, 60)} c d"}
    monkeypatch.setattr(J, "_near_leaders", lambda docs, nodes, n, percent: nodes.select(
        F.col("sig").alias("a"), F.col("sig").alias("b")).limit(0))
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(docs)).collect()}
    assert got == {k: 100 if k == 101 else k for k in docs}
    assert kept["classes"].count() == 62 and 2 <= kept["met"].count() <= 4
