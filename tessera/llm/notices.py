"""Licence scan: short notices found with a bounded number of edits.

A notice is a phrase of a few words with a label.  Texts are taken in normal
form: A-Z lower-cased, words (runs of bytes outside 00-2F, 3A-60 and 7B-7F)
joined by one space.  A place is a stretch of whole words whose normal form
is at most k edits (characters put in, left out or changed) away from the
notice's; k is one for each ``chars_per_edit`` characters of the notice, none
for a notice below ten.  Words of at most three characters ("mit", "gnu")
carry the sense and must be among the place's words unchanged.

Search: a notice is split into k + 1 pieces.  Whatever k edits do, one piece
stays whole, so an Aho-Corasick automaton over all pieces of all notices
reads each text once, and only the stretches of words whose ends lie within k
characters of where a found piece puts them are candidates.  The regex
library's bounded-error matching verifies each: the smallest bound under
which it matches the whole stretch is its number of edits.

Of overlapping places of one notice those with fewer edits stay, then the
one that starts first, then the shorter; exact places all stay.

Scale: documents are mapped, never shuffled; what every task holds is the
list of notices, at most ``MAX_NOTICES`` (else ValueError).

Defined results: null and empty texts have no words and no places; repeated
rows, equal and null ids each give their own row; other columns are ignored.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced
from .decontaminate import words_of

#: (label, notice): the phrases that op11 counts as base.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
#: Further notices of common licences.
FURTHER = (
    ("lgpl", "gnu lesser general public license"), ("agpl", "gnu affero general public license"),
    ("gfdl", "gnu free documentation license"), ("bsd", "bsd license"), ("bsd", "bsd 2 clause license"),
    ("bsd", "bsd 3 clause license"), ("mpl", "mozilla public license"), ("epl", "eclipse public license"),
    ("isc", "isc license"), ("bsl", "boost software license"), ("cc-by", "creative commons attribution"),
    ("cc0", "cc0 1 0 universal"), ("cc0", "creative commons zero"),
)
MAX_NOTICES = 10_000
#: The words of a text, in which A-Z are still as they were.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Notice:
    def __init__(self, label: str, phrase: str, chars_per_edit: int):
        self.label = label
        self.phrase = " ".join(w.decode() for w in words_of(phrase))
        self.edits = len(self.phrase) // chars_per_edit if len(self.phrase) >= 10 else 0
        self.exact = Counter(w for w in self.phrase.split(" ") if len(w) <= 3)

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): k + 1 parts of nearly one length."""
        n, k = len(self.phrase), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds the notices in one text."""

    def __init__(self, notices: Sequence[tuple[str, str]], chars_per_edit: int):
        import ahocorasick
        import regex
        self.notices = [Notice(label, phrase, chars_per_edit) for label, phrase in notices]
        self.notices = [n for n in self.notices if n.phrase]
        at: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            for offset, piece in n.pieces():
                at.setdefault(piece, []).append((i, offset + len(piece) - 1))
        self.seeds = ahocorasick.Automaton()
        for piece, where in at.items():
            self.seeds.add_word(piece, where)
        if at:
            self.seeds.make_automaton()
        bound = [[regex.compile(f"(?:{regex.escape(n.phrase)}){{e<={e}}}") if e else regex.compile(regex.escape(n.phrase))
                  for e in range(n.edits + 1)] for n in self.notices]

        @lru_cache(200_000)
        def edits(i: int, stretch: str) -> int | None:
            if self.notices[i].exact - Counter(stretch.split(" ")):
                return None
            return next((e for e, p in enumerate(bound[i]) if p.fullmatch(stretch)), None)
        self.edits = edits

    def candidates(self, joined: str, place: dict[int, int]) -> set[tuple[int, int, int]]:
        """(notice, first word, end word) of stretches that a seed suggests."""
        ends = {s - 1: w for s, w in place.items()}       # the space after word w-1, or the text's end
        found = set()
        for at, where in self.seeds.iter(joined):         # at: the piece's last character
            for i, inside in where:
                n = self.notices[i]
                k, begin = n.edits, at - inside
                found.update((i, place[s], ends[e]) for s in range(begin - k, begin + k + 1) if s in place
                             for e in range(begin + len(n.phrase) - k, begin + len(n.phrase) + k + 1)
                             if e in ends and ends[e] > place[s])
        return found

    def places(self, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(notice, first word, end word, edits) by first word."""
        joined = b" ".join(words).decode()
        if not words or not self.notices or next(self.seeds.iter(joined), None) is None:
            return []
        split = joined.split(" ")
        starts = list(accumulate((len(w) + 1 for w in split), initial=0))
        place = {s: w for w, s in enumerate(starts)}
        hits = []
        for i, x, y in self.candidates(joined, place):
            if x < len(split):
                e = self.edits(i, joined[starts[x]:starts[y] - 1])
                if e is not None:
                    hits.append((i, e, x, y))
        out: list[tuple[int, int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for i, e, x, y in sorted(hits):
            own = taken.setdefault(i, [])
            if e == 0 or not any(x < b and a < y for a, b in own):
                own.append((x, y))
                out.append((i, x, y, e))
        return sorted(out, key=lambda p: (p[1], p[2], p[0]))


_scanners: dict = {}


def _scanner(notices: tuple, chars_per_edit: int) -> Scanner:
    if (notices, chars_per_edit) not in _scanners:
        _scanners[notices, chars_per_edit] = Scanner(notices, chars_per_edit)
    return _scanners[notices, chars_per_edit]


_PLACE = ("label: string, notice: string, first_word: long, end_word: long, first_char: long, end_char: long, "
          "edits: int, score: double")


def find_notices(docs: DataFrame, notices: Sequence[tuple[str, str]] = BASE + FURTHER, *, chars_per_edit: int = 7,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, places): places by first word, each with its label,
    notice, words [first_word, end_word), characters [first_char, end_char)
    of the text as it is, edits, and score, one less edits by the notice's
    length."""
    notices = tuple((str(a), str(b)) for a, b in notices)
    if len(notices) > MAX_NOTICES:
        raise ValueError(f"more than {MAX_NOTICES} notices")
    kind = docs.schema[doc_id].dataType.simpleString()
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    place = pa.struct([("label", pa.string()), ("notice", pa.string()), *[(f, pa.int64()) for f in (
        "first_word", "end_word", "first_char", "end_char")], ("edits", pa.int32()), ("score", pa.float64())])

    def run(batches):
        scan = _scanner(notices, chars_per_edit)
        for batch in batches:
            for part in sliced(batch):
                n_words, places = [], []
                for t in part.column(1).to_pylist():
                    words = words_of(t)
                    n_words.append(len(words))
                    got = scan.places(words)
                    at = [m.span() for m in _WORD.finditer(t)] if got else []
                    places.append([(scan.notices[i].label, scan.notices[i].phrase, x, y, at[x][0], at[y - 1][1], e,
                                    1 - e / len(scan.notices[i].phrase)) for i, x, y, e in got])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()),
                     pa.array([[dict(zip(place.names, p)) for p in ps] for ps in places], pa.list_(place))],
                    [doc_id, "n_words", "places"])
    return src.mapInArrow(run, f"`{doc_id}` {kind}, n_words long, places array<struct<{_PLACE}>>")
