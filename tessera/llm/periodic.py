"""Periodic runs of words by branching tandem repeats on an enhanced suffix
array.

A run is a maximal stretch of words with smallest period q that is at least
``exponent`` periods and ``least`` words long.  The words of some documents
(one slice of a task's rows) become numbers that differ between documents,
and the suffix array of their sequence is built by prefix doubling; the ranks
of every round are kept.  From them come

* the LCP of neighbours in the suffix array, by falling powers of two;
* the LCP intervals, by nearest smaller values on a table of range minima, so
  that no tree node is made: an interval is its bounds and its depth d;
* for each suffix i of all children but the largest of an interval, whether
  ISA[i + d] or ISA[i - d] lies in the interval outside i's child.  If so, the
  two suffixes share exactly d words: a square of period d that branches, the
  last of its run.  Each suffix is looked at O(log n) times in all;
* the first word of the run, by rotating the square to the left, again in
  falling powers of two.  Squares of one run meet in (start, end); the least
  period stays.

An interval of depth d above 1/exponent of its document has no run that is
long enough and is passed over.

Scale: documents are mapped, never shuffled.  A task holds one slice, of
about a megabyte of text, or one longer document: 4 bytes for each word and
round, and the rounds are the logarithm of the longest repeat.

Defined results: null and empty texts, and texts without white-space words,
have no words and no runs; repeated rows, equal and null ids each give their
own row; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, its inverse, ranks by the first 1, 2, 4, ... codes).  A
    rank is the place of the group's first suffix; suffixes that are alone in
    their group are settled and not sorted again."""
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1                                      # the end, before all
    new = np.ones(n, bool)
    new[1:] = codes[sa[1:]] != codes[sa[:-1]]
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank.astype(np.int32)], 1
    open_ = ~(new & np.append(new[1:], True))         # places whose suffix shares its rank
    while open_.any():
        slots = np.flatnonzero(open_)
        at = sa[slots]
        key = rank[at] * (n + 1) + rank[np.minimum(at + step, n)] + 1
        order = np.argsort(key, kind="stable")        # groups keep their places: ranks are ascending by slot
        at, key = at[order], key[order]
        sa[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[at] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32))
        open_[slots] = ~(fresh & np.append(fresh[1:], True))
        step *= 2
    return sa, rank[:n], levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b (a != b)."""
    n = len(levels[0]) - 1
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][np.minimum(a + out, n)] == levels[k][np.minimum(b + out, n)]).astype(np.int64) << k
    return out


def common_suffix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes before a equal those before b (a < b)."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a - out - (1 << k), b - out - (1 << k)
        out += ((x >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(y, 0)])).astype(np.int64) << k
    return out


def nearest_smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last place before and the first place after each ``at`` whose LCP
    is smaller; both ends of ``lcp`` are -1."""
    n, depth = len(lcp), lcp[at]
    wide = np.flatnonzero(lcp < 1)                    # blocks of positive LCP bound the search
    longest = int(np.diff(wide).max(initial=1))
    table = [lcp]
    while 1 << len(table) <= longest:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    left, right = at.copy(), at.copy() + 1
    for k in range(len(table) - 1, -1, -1):
        x = left - (1 << k)
        left = np.where((x >= 0) & (table[k][np.maximum(x, 0)] >= depth), x, left)
        last = len(table[k]) - 1
        right = np.where((right <= last) & (table[k][np.minimum(right, last)] >= depth), right + (1 << k), right)
    return left - 1, right


def branching_squares(sa, isa, levels, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of squares whose two halves are followed by different
    codes.  ``room``: the longest period that matters at each code."""
    n, none = len(sa), np.zeros(0, np.int64)
    if n < 2:
        return none, none
    lcp = np.full(n + 1, -1, np.int64)
    lcp[1:n] = common_prefix(levels, sa[:-1], sa[1:])
    at = np.flatnonzero((lcp[:n] >= 1) & (lcp[:n] <= room[sa]))
    if not len(at):
        return none, none
    lo, hi = nearest_smaller(lcp, at)
    # borders of one interval's children stand together, in order
    order = np.lexsort((at, lcp[at], lo))
    at, lo, hi = at[order], lo[order], hi[order]
    depth = lcp[at]
    new = np.ones(len(at), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (depth[1:] != depth[:-1])
    own = np.cumsum(new) - 1                          # interval of each border
    first = np.flatnonzero(new)
    lo, hi, depth = lo[first], hi[first], depth[first]
    # children: from the interval's start to the first border, and from each border to the next
    begin = np.concatenate([lo, at])
    parent = np.concatenate([np.arange(len(first)), own])
    order = np.lexsort((begin, parent))
    begin, parent = begin[order], parent[order]
    end = np.append(begin[1:], 0)
    closes = np.append(parent[1:] != parent[:-1], True)
    end[closes] = hi[parent[closes]]
    size = end - begin
    largest = np.lexsort((-size, parent))[np.flatnonzero(np.diff(parent, prepend=-1))]
    small = np.ones(len(size), bool)
    small[largest] = False
    begin, end, parent, size = begin[small], end[small], parent[small], size[small]
    starts, periods = [], []
    ends, x = np.cumsum(size), 0
    while x < len(size):                              # a bounded number of suffixes at a time
        y = max(int(np.searchsorted(ends, (ends[x - 1] if x else 0) + (1 << 21), "right")), x + 1)
        s = size[x:y]
        child = np.repeat(np.arange(x, y), s)
        i = sa[np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s - begin[x:y], s)]
        d, l, r = depth[parent[child]], lo[parent[child]], hi[parent[child]]
        for other in (i + d, i - d):
            place = isa[np.clip(other, 0, n - 1)]
            hit = ((other >= 0) & (other < n) & (place >= l) & (place < r)
                   & ((place < begin[child]) | (place >= end[child])))
            starts.append(np.minimum(i, other)[hit])
            periods.append(d[hit])
        x = y
    key = np.unique(np.concatenate(starts) * (n + 1) + np.concatenate(periods))
    return key // (n + 1), key % (n + 1)


def runs_of(codes: np.ndarray, first: np.ndarray, exponent: int, least: int):
    """(document, start, length, period) of all runs, by document, start and
    period.  ``first``: each document's first code; codes of different
    documents differ."""
    words = np.diff(first)
    sa, isa, levels = suffix_array(codes)
    i, d = branching_squares(sa, isa, levels, np.repeat(words // exponent, words))
    start = i - common_suffix(levels, i, i + d)
    end = i + 2 * d
    keep = end - start >= np.maximum(least, exponent * d)
    start, end, d = start[keep], end[keep], d[keep]
    order = np.lexsort((d, end, start))
    start, end, d = start[order], end[order], d[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, d = start[new], end[new], d[new]
    order = np.lexsort((d, start))
    start, end, d = start[order], end[order], d[order]
    doc = np.searchsorted(first, start, "right") - 1
    return doc, start - first[doc], end - start, d


def kept_words(words: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Flags of the words that no run holds after its first period."""
    step = np.zeros(words + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step)[:words] == 0


def _codes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, different between documents, and each
    document's first word."""
    numbers: dict[bytes, int] = {}
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(first[-1]))
    return np.repeat(np.arange(len(texts)), np.diff(first)) * max(len(numbers), 1) + flat, first


def periodic_runs(docs: DataFrame, *, exponent: int = 4, least: int = 6, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): a document's runs by start and
    period, and its words without what repeats, joined by single spaces.
    Words are those between ASCII white space; ``exponent`` is 3 or more, so
    that a stretch's smallest period decides."""
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    kind = docs.schema[doc_id].dataType.simpleString()
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for part in sliced(batch):
                texts = [(t or b"").split() for t in part.column(1).to_pylist()]
                codes, first = _codes(texts)
                doc, start, length, period = runs_of(codes, first, exponent, least)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                out = []
                for k, words in enumerate(texts):
                    x, y = cut[k], cut[k + 1]
                    if y > x:
                        keep = kept_words(len(words), start[x:y], length[x:y], period[x:y])
                        words = [words[j] for j in np.flatnonzero(keep).tolist()]
                    out.append(b" ".join(words).decode())
                runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)), runs, pa.array(out, pa.string())],
                    [doc_id, "n_words", "runs", "collapsed"])
    return src.mapInArrow(run, f"`{doc_id}` {kind}, n_words long, "
                               "runs array<struct<start: long, length: long, period: long>>, collapsed string")
