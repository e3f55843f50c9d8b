import hashlib
import random
import re

import numpy as np
import pytest

from tessera.llm import doubling, fmindex, spans
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(docs, units, join, window):
    least, out = {}, []
    cut = [(i, units(t)) for i, t in docs]
    for i, u in cut:
        for k in range(len(u) - window + 1):
            w = tuple(u[k:k + window]) if isinstance(u, list) else u[k:k + window]
            if i is not None:
                least[w] = min(i, least.get(w, i))
    for i, u in cut:
        gone = np.zeros(len(u), bool)
        for k in range(len(u) - window + 1):
            w = tuple(u[k:k + window]) if isinstance(u, list) else u[k:k + window]
            if i is not None and least[w] < i:
                gone[k:k + window] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = join([x for x, g in zip(u, gone) if not g])
        out.append((i, len(u), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words(t):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]


KINDS = {"op5_fm_index": (words, b" ".join, 13), "op10_prefix_doubling": (lambda t: (t or "").encode(), bytes, 50)}


@pytest.mark.parametrize("key", KINDS)
def test_query_against_brute_force(spark, key):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES[key](spark, SF).collect()), key=str)
    want = brute(docs, *KINDS[key])
    assert got == (want if key == "op10_prefix_doubling" else [w[:3] + w[4:] for w in want])
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("key", KINDS)
@pytest.mark.parametrize("ids", [0, 1000])
def test_random_texts_and_edges(docs_of, monkeypatch, key, ids):
    monkeypatch.setattr(spans, "BROADCAST_IDS", ids)
    monkeypatch.setattr(spans, "SHARD_SEGMENTS", 50)
    rnd = random.Random(4)
    vocab = ["ab", "c", "é", "dd", "e-e", "f"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", "  ", "\n"]) for _ in range(n))
    common = text(40)
    docs = [(i, text(rnd.randrange(0, 60)) + (common if i % 3 == 0 else "") + text(9)) for i in range(60)]
    docs += [(70, docs[9][1]), (71, docs[9][1]), (71, docs[9][1]), (72, "a " * 3000), (73, "a " * 60), (80, None),
             (81, ""), (82, " \t"), (3, common), (None, common), (90, "x " * 90000 + common)]
    rows = docs_of({}).sparkSession.createDataFrame(
        [(i, t, "en", "s", 0) for i, t in rnd.sample(docs, len(docs))],
        "doc_id long, text string, rid string, id string, n_chars long")
    units, join, _ = KINDS[key]
    for window, gram in ((6, 2), (6, 6), (11, 3)):
        if key == "op5_fm_index":
            got = fmindex.remove_repeats(rows, window=window, gram=gram).collect()
        else:
            got = doubling.remove_repeats(rows, length=window * 2, gram=gram).collect()
        got = sorted(((r[0], r[1], r[2], len(r.spans), r.kept_sha256) for r in got), key=str)
        assert got == brute(docs, units, join, window * (1 if key == "op5_fm_index" else 2))
    op = fmindex.remove_repeats if key == "op5_fm_index" else doubling.remove_repeats
    assert op(rows.limit(0)).collect() == []


def test_index_and_ranks():
    rng = np.random.RandomState(0)
    t = np.append(rng.randint(1, 4, 500), 0)
    index = fmindex.FmIndex(t, 5)
    starts = np.arange(400)
    place, matched = index.windows(starts, 5)
    seen = {}
    for i in starts:
        seen.setdefault(tuple(t[i:i + 5]), []).append(i)
    whole = {tuple(t[i:i + 5]): 0 for i in range(496)}
    for i in range(496):
        whole[tuple(t[i:i + 5])] += 1
    for w, at in seen.items():
        assert len({place[i] for i in at}) == 1 and (place[at[0]] >= 0) == (whole[w] > 1)
        assert whole[w] == 1 or all(matched[i] == 5 for i in at)
    w = fmindex.WaveletMatrix(t, 2)
    at, sym = rng.randint(0, 502, 300), rng.randint(0, 4, 300)
    assert w.rank(sym, at).tolist() == [int((t[:a] == s).sum()) for a, s in zip(at, sym)]


@pytest.mark.parametrize("key", KINDS)
def test_only_grams_wider_than_the_anchor_meet(docs_of, key):
    """Documents that share an anchor, but no window, send no segment; those that share a window all set its place."""
    word = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    shared, docs = "the same five words here", []
    for k in range(40):
        docs.append((k, f"{word(2 * k, 20)} {shared} {word(2 * k + 1, 20)}"))
    kind = (True, 13, 5) if key == "op5_fm_index" else (False, 50, 16)
    rows = spans.prepare(docs_of(dict(docs)), "doc_id", "text")
    assert not spans._shared_grams(rows, *kind, 20).any()
    again = spans.prepare(docs_of(dict(docs) | {50: f"{word(90, 9)} {docs[0][1]} {word(91, 9)}"}), "doc_id", "text")
    assert spans._shared_grams(again, *kind, 20).any()


def test_slices_of_bytes_are_bounded():
    import tracemalloc

    import pyarrow as pa
    rnd = random.Random(5)
    batch = pa.RecordBatch.from_arrays([pa.array(["".join(rnd.choice("abcdefgh ") for _ in range(2000))] * 500)], ["text"])
    tracemalloc.start()
    n = sum(len(spans.Units(b.column(0), False, 50, 16).begin) for b in spans._slices([batch], False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 10000 and peak < 30e6


def test_runs_of_many_parts_in_one_pass():
    parts = [np.array(x) for x in ([5, 5, 3], [3], [3, 3, 7, 7, 7], [7, 1])]
    runs, mins, n = spans.equal_runs(parts)
    assert [divmod(r, spans.RUN) for r in runs.tolist()] == [(0, 2), (2, 3), (0, 1), (0, 2), (2, 5), (0, 1), (1, 2)]
    assert mins.tolist() == [5, 3, 3, 3, 7, 7, 1] and n.tolist() == [2, 1, 2, 2]
    assert [x.tolist() for x in spans.equal_runs([])] == [[], [], []]
