import random
import re

import pytest

from tessera.llm import notices as N
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
CLASS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return CLASS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(text, notices, per_edit):
    """Every stretch of words against every notice by edit distance."""
    words, out = words_of(text), []
    for label, phrase in notices:
        k = len(phrase) // per_edit if len(phrase) >= 10 else 0
        need = [w for w in phrase.split() if len(w) <= 3]
        hits = []
        for x in range(len(words)):
            for y in range(x + 1, len(words) + 1):
                s = " ".join(words[x:y])
                if len(s) > len(phrase) + k:
                    break
                if len(s) >= len(phrase) - k and all(words[x:y].count(w) >= need.count(w) for w in need):
                    d = distance(s, phrase)
                    if d <= k:
                        hits.append((d, x, y))
        kept = []
        for d, x, y in sorted(hits):
            if d == 0 or not any(x < b and a < y for _, a, b in kept):
                kept.append((d, x, y))
        out += [(phrase, x, y, d) for d, x, y in kept]
    return len(words), sorted(out)


def spoil(rnd, phrase):
    s = list(phrase)
    for _ in range(rnd.randrange(5)):
        at = rnd.randrange(len(s))
        s[at:at + rnd.randrange(2)] = rnd.choice(["", "x", " ", s[at], "é"])
        s = s or ["q"]
    return "".join(s)


@pytest.mark.parametrize("seed", range(8))
def test_places_against_edit_distance(seed):
    rnd = random.Random(seed)
    notices = N.BASE + N.FURTHER + (("x", "aa aa aaaa aa"), ("x", "aaaa aaaa aaaa aaaa"))
    scan = N.Scanner(notices, rnd.choice([4, 6, 8]))
    per = len(scan.notices[0].phrase) // scan.notices[0].edits
    per = {6: 4, 4: 6, 3: 8}[scan.notices[0].edits]
    for _ in range(60):
        text = " ".join(rnd.choice([spoil(rnd, rnd.choice(notices)[1]), "license", "mit", "aaaa", "aa aaa", "the cc",
                                    "public", "word"]) for _ in range(rnd.randrange(7)))
        n, want = brute(text, notices, per)
        words = [w.encode() for w in words_of(text)]
        assert len(words) == n
        assert sorted((scan.notices[i].phrase, x, y, e) for i, x, y, e in scan.places(words)) == want


def base_places(text):
    words = words_of(text)
    return sorted((x, label) for label, phrase in N.BASE for x in range(len(words))
                  if words[x:x + len(phrase.split())] == phrase.split())


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_notices"](spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == set(docs)
    base = 0
    for i, t in docs.items():
        want, r = base_places(t), rows[i]
        base += len(want)
        assert (r.n_words, r.n_base) == (len(words_of(t)), len(want))
        assert (r.first_word, r.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in want}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        if want:
            assert r.score == 1.0
        elif len(t or "") < 700:
            _, fuzzy = brute(t, N.BASE + N.FURTHER, 7)
            assert bool(fuzzy) == (r.score > 0) == bool(r.labels)
    assert base > 20


def test_spelling_variants_and_odd_rows(spark, small):
    texts = {1: "Released under the MIT Licence.", 2: "the APACHE-Lisence, v2", 3: "GNU Genral Public License",
             4: "CC-BY 4.0; cc by; CC BY", 5: "with it license; emit license", 6: None, 7: "", 8: "?!",
             9: "GNU Lesser General Public License", 10: "MIT License " * 20000, 11: "été MIT\x00\nLicense ☃"}
    docs = small([(i, t, "m") for i, t in texts.items()] + [(None, "mit license", "m"), (1, texts[1], "m")],
                 "doc_id long, text string, places string")
    rows = N.find_notices(docs).collect()
    got = {r.doc_id: [(p.label, p.edits) for p in r.places] for r in rows}
    assert len(rows) == 13
    assert got[1] == [("mit", 1)] and got[2] == [("apache", 2)] and got[3] == [("gpl", 1)]
    assert got[4] == [("cc-by", 0)] * 3 and got[5] == [] and got[9] == [("lgpl", 0)] and got[None] == [("mit", 0)]
    assert got[6] == got[7] == got[8] == [] and got[10] == [("mit", 0)] * 20000
    for r in rows:
        text = texts.get(r.doc_id, "mit license")
        words = words_of(text)
        for p in r.places:
            assert words_of(text[p.first_char:p.end_char]) == words[p.first_word:p.end_word]
    assert N.find_notices(docs.limit(0)).collect() == []
    assert [r.places for r in N.find_notices(docs, []).collect()] == [[]] * 13
    with pytest.raises(ValueError):
        N.find_notices(docs, [("a", "b")] * (N.MAX_NOTICES + 1))
