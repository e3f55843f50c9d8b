import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm import periodic as R
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_runs(words, exponent=4, least=6):
    """Every period at every start, by definition; the smallest period of a
    stretch decides."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n_, q) for (s, n_), q in found.items())


def brute_collapse(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(doc_id, text):
    words = changed(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(brute_collapse(words, runs)).encode()).hexdigest())


def test_query_against_brute_force(spark):
    short = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op12_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(short)
    checked = [(i, t) for i, t in short if len((t or "").split()) <= 1500]
    assert len(checked) > 900
    for i, t in checked:
        assert rows[i] == digest(i, t)


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    docs = []
    for _ in range(12):
        words = [rnd.choice("ab" if seed % 2 else "abcd") for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            piece = [rnd.choice("abc") for _ in range(rnd.randrange(1, 7))]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = (piece * 9)[:len(piece) * rnd.randrange(3, 8) + rnd.randrange(len(piece))]
        docs.append(words)
    codes, first = R._codes([[w.encode() for w in d] for d in docs])
    exponent, least = rnd.choice([(4, 6), (3, 2), (4, 1), (5, 12)])
    doc, start, length, period = R.runs_of(codes, first, exponent, least)
    for k, words in enumerate(docs):
        own = doc == k
        got = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist()))
        assert got == brute_runs(words, exponent, least)


def test_suffix_array_and_intervals():
    rnd = np.random.default_rng(5)
    codes = np.concatenate([rnd.integers(0, 3, 200), np.full(50, 1), rnd.integers(0, 3, 100)])
    sa, isa, levels = R.suffix_array(codes)
    text = codes.tolist()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert (isa[sa] == np.arange(len(sa))).all()
    want = []
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        want.append(k)
    assert R.common_prefix(levels, sa[:-1], sa[1:]).tolist() == want


def test_odd_rows(spark, small):
    long = "x y z " * 30000
    docs = small([(1, None, 1), (2, "", 1), (3, " \t ", 1), (4, "a " * 6, 1), (4, "a " * 6, 1), (4, "a " * 5, 1),
                  (None, "p q p q p q p q p", 1), (5, long, 1), (6, "é ß é ß é ß é ß ÿ b b b b b b", 1)],
                 "doc_id long, text string, runs int")
    rows = R.periodic_runs(docs).collect()
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows), key=repr)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
        (4, 5, [], "a a a a a"), (0, 9, [(0, 9, 2)], "p q"), (5, 90000, [(0, 90000, 3)], "x y z"),
        (6, 15, [(0, 8, 2), (9, 6, 1)], "é ß ÿ b")], key=repr)
    assert R.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        R.periodic_runs(docs, exponent=2)
