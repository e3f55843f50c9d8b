import hashlib
import random
import re

from conftest_llm import frame_of
from tessera.llm import decontaminate as D
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, window=10):
    wins, out = {}, []
    for name, t in items:
        w = WORD.findall(low(t))
        for k in range(max(len(w) - window + 1, min(len(w), 1))):
            wins.setdefault(tuple(w[k:k + window]), set()).add(name)
    sizes = sorted({len(w) for w in wins})
    for i, t in docs:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for k in range(len(w)):
            for n in sizes:
                names = wins.get(tuple(w[k:k + n])) if k + n <= len(w) else None
                if names:
                    hit |= set(range(k, k + n))
                    found |= names
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op1_decontaminate"](spark, SF).collect()), key=str)
    assert got == brute(docs, items)
    assert any(r[-1] for r in got)


def test_random_words_short_items_and_shards(spark, small, docs_of, monkeypatch):
    rnd = random.Random(3)
    monkeypatch.setattr(D, "PIECE_WORDS", 14)
    words = ["a", "b", "C", "é"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    docs = {i: text(rnd.randrange(0, 60)) for i in range(40)} | {90: None, 91: "", 92: "a" * 70000}
    items = [(i, text(rnd.choice([1, 2, 3, 5, 20, 40]))) for i in range(6)] + [(7, None), (8, "... "), (6, "b b b")]
    bench = small(items, "item_id long, text string")
    for shard_words in (10_000, 20):
        rows = D.find_contamination(docs_of(docs), bench, window=4, shard_words=shard_words).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]),
                       hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in rows), key=str)
        assert got == brute(docs.items(), items, 4)


def test_removal_and_edges(spark, small, docs_of):
    bench = small([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    clean = "some words, then " + "x " * 40
    leak = clean + "One two three four, five six seven eight nine ten eleven! tail here"
    docs = docs_of({1: clean, 2: leak, 3: "one two three four five six seven eight nine ten", 4: None, 5: ""})
    docs = docs.withColumnRenamed("lang", "n_hit")        # a clashing name stays what it is
    out = {r.doc_id: r for r in D.remove_contamination(docs, bench, n_chars="n_chars").collect()}
    assert frame_of(docs).keys() == frame_of(docs.limit(0)).keys()
    assert set(out) == {1, 2, 4, 5} and out[1].text == clean and out[1].n_hit == "en"
    assert "seven" not in out[2].text and out[2].text.endswith("! tail here") and out[2].n_chars == len(out[2].text)
    none = D.find_contamination(docs.limit(0), bench.limit(0)).collect()
    assert none == [] and D.find_contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
