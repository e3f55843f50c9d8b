"""Substring removal by a compressed FM-index per shard.

The words of a shard's distinct segments become symbols; their concatenation
is indexed by its Burrows-Wheeler transform in a wavelet matrix of packed bit
vectors.  Backward search takes the windows of all segments through the index
at once, one word further left in each step; a window's search ends when its
interval holds one occurrence only, and the matching length it has reached by
then is its matching statistic.  Windows of full length are reported by
interval, and the smallest id of an interval's occurrences is the answer.

See ``spans`` for how documents come to shards and answers to documents.

Defined results: null and empty texts have no words; documents of fewer words
than the window lose nothing; ids are integers, a null id neither removes nor
loses; rows that share an id do not remove each other's words; repeated rows
are treated alike; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .common import SPACES, merge_runs, word_spans
from .spans import EVERY, marked_windows, prepare, remove_marked


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their next ``depth`` symbols or more."""
    n = len(text)
    rank, size = text.astype(np.int64), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:max(n - size, 0)] = rank[size:] + 1
        key = rank * (n + 2 + int(text.max(initial=0))) + nxt
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        size *= 2
        if size >= depth or new[-1] == n - 1:
            return order


class WaveletMatrix:
    """Rank queries over symbols below 2^levels; one packed bit vector with
    counts per 64 bits for each level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.n, self.rows = levels, len(symbols), []
        for k in range(levels - 1, -1, -1):
            bit = (symbols >> k & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[:self.n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int64)
            self.rows.append((k, packed, before, self.n - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(packed, before, at):
        low = packed[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[at >> 6] + np.bitwise_count(low)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        lo, hi = np.zeros(len(at), np.int64), at
        for k, packed, before, zeros in self.rows:
            one = (symbol >> k & 1).astype(bool)
            a, b = self._ones(packed, before, lo), self._ones(packed, before, hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo


class FmIndex:
    """Index of a sequence of symbols (0 is the separator)."""

    def __init__(self, text: np.ndarray, depth: int):
        order = suffix_array(text, depth)
        self.text = text
        self.bwt = WaveletMatrix(text[order - 1], max(1, int(text.max(initial=1)).bit_length()))
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max(initial=0)) + 1))])

    def step(self, symbol, lo, hi):
        """Intervals of ``symbol`` + pattern, from those of the patterns."""
        both = self.bwt.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(
            self.less[symbol], 2)
        return both[:len(lo)], both[len(lo):]

    def windows(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For the windows of the text at ``starts``: the first place of
        their interval, or -1 where a suffix of it occurs once only; and the
        matching length reached."""
        alive = np.arange(len(starts))
        last = self.text[starts + length - 1]
        lo, hi = self.less[last], self.less[last + 1]
        matched = np.ones(len(starts), np.int64)
        for k in range(length - 2, -1, -1):
            many = hi - lo > 1
            alive, lo, hi = alive[many], lo[many], hi[many]
            if not len(alive):
                break
            lo, hi = self.step(self.text[starts[alive] + k], lo, hi)
            matched[alive] += 1
        out = np.full(len(starts), -1, np.int64)
        out[alive[hi - lo > 1]] = lo[hi - lo > 1]
        return out, matched


def least_ids(contents: list[bytes], least: np.ndarray, window: int) -> list[np.ndarray]:
    """For each segment the smallest id of each of its windows."""
    codes: dict[bytes, int] = {}
    text, size = [], []
    for c in contents:
        words = c.split()
        size.append(len(words))
        text += [codes.setdefault(w, len(codes) + 1) for w in words]
        text.append(0)
    text, size = np.array(text, np.int64), np.array(size, np.int64)
    base = np.cumsum(size + 1) - size - 1
    n = size - window + 1
    seg = np.repeat(np.arange(len(size)), n)
    starts = base[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    place, _ = FmIndex(text, window).windows(starts, window)
    own = least[seg]
    many = np.flatnonzero(place >= 0)
    if len(many):
        order = many[np.argsort(place[many], kind="stable")]
        cuts = np.flatnonzero(np.concatenate([[True], place[order][1:] != place[order][:-1]]))
        own[order] = np.repeat(np.minimum.reduceat(least[seg[order]], cuts), np.diff(np.append(cuts, len(order))))
    return np.split(own, np.cumsum(n)[:-1])


def remove_repeats(docs: DataFrame, *, window: int = 13, gram: int = 5, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed word
    runs [start, end)), and kept, the other words joined by one space, in
    UTF-8, with its sha256.  A word goes if a window of ``window`` words
    around it also starts in a document with a smaller id."""
    rows = prepare(docs, doc_id, text)
    marks = marked_windows(rows, lambda c, least: least_ids(c, least, window), words=True, window=window, gram=gram)

    def cut(raw: bytes, starts: np.ndarray):
        a = np.frombuffer(raw, np.uint8)
        s, e, _ = word_spans(a, np.array([0, len(a)]), SPACES)
        if EVERY in starts:
            starts = np.arange(max(len(s) - window + 1, 0))
        lo, hi = merge_runs(starts, starts + window)
        keep = np.ones(len(s), bool)
        for x, y in zip(lo, hi):
            keep[x:y] = False
        kept = b" ".join(raw[x:y] for x, y in zip(s[keep].tolist(), e[keep].tolist()))
        return (len(s), int((~keep).sum()), [[int(x), int(y)] for x, y in zip(lo, hi)], kept,
                hashlib.sha256(kept).hexdigest())
    out = remove_marked(rows, marks, cut, "n_words long, n_removed long, spans array<array<long>>, kept binary, "
                                          "kept_sha256 string")
    return out.withColumnRenamed("id", doc_id)
