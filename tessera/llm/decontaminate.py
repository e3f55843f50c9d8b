"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items go into one suffix automaton per
shard of items.  Document words are streamed through it; the automaton's
state and match length give, at each word, the longest run of words ending
there that occurs in an item.  A run of ``window`` words is a hit, and so is
a whole item shorter than that.

Normal form: A-Z lower-cased; a word is a run of bytes outside
00-2F, 3A-60 and 7B-7F, so letters, digits and everything beyond ASCII.

Scale: the documents are scanned once per shard of ``shard_words`` item
words and never shuffled.  A shard is a bounded broadcast whatever the size
of the benchmark; long items are cut into overlapping pieces first, which
have the same windows.

Defined results: null and empty texts have no words and no hits; a null or
word-less item is ignored; items that share an id count once; items with a
null id mark words but are not listed; repeated documents give repeated
rows; columns of ``docs`` other than those named are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, map_batches, merge_runs, stage_table, word_spans

_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if ALNUM[b] or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
PIECE_WORDS = 4000


def words_of(text: str | bytes | None) -> list[bytes]:
    """Normalised words of a text (UTF-8 bytes)."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return raw.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the items of every
    ``window``-word run and of every shorter whole item."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [self.ids.setdefault(w, len(self.ids)) for w in words]))
                last = 0
                for c in coded[-1][1]:
                    last = self._extend(last, c)
        self._annotate(coded)

    def _new(self, length: int, link: int, trans: dict[int, int]) -> int:
        self.next.append(trans)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """State for the strings of q no longer than length(p) + 1."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        cur, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return cur

    def _annotate(self, coded) -> None:
        n, w = len(self.length), self.window
        order = sorted(range(1, n), key=self.length.__getitem__)
        # the ancestor whose strings include the last `window` words
        self.base = [-1] * n
        for v in order:
            if self.length[v] >= w:
                self.base[v] = v if self.length[self.link[v]] < w else self.base[self.link[v]]
        self.items: dict[int, set] = {}
        self.short: dict[int, tuple[int, set]] = {}
        for name, codes in coded:
            v = 0
            for i, c in enumerate(codes):
                v = self.next[v][c]
                if i + 1 >= w:
                    self.items.setdefault(self.base[v], set()).add(name)
            if len(codes) < w:
                self.short.setdefault(v, (len(codes), set()))[1].add(name)
        # nearest state at or above that ends a short whole item
        self.above = [-1] * n
        for v in order:
            self.above[v] = v if v in self.short else self.above[self.link[v]]

    def scan(self, words: list[bytes]) -> tuple[list[int], list[int], set, int]:
        """Starts and ends of the hit runs (they may overlap), the items
        that occur, and the longest match."""
        starts, ends, found, longest = [], [], set(), 0
        nxt, link, length, base, above, w = self.next, self.link, self.length, self.base, self.above, self.window
        v = n = 0
        for i, c in enumerate(map(self.ids.get, words)):
            if c is None:
                v = n = 0
                continue
            t = nxt[v].get(c)
            while t is None and v:
                v = link[v]
                n = length[v]
                t = nxt[v].get(c)
            if t is None:
                continue
            v = t
            n += 1
            if n > longest:
                longest = n
            if n >= w:
                starts.append(i + 1 - w)
                ends.append(i + 1)
                found |= self.items[base[v]]
            u = above[v]
            while u >= 0:
                k, names = self.short[u]
                if k <= n:
                    starts.append(i + 1 - k)
                    ends.append(i + 1)
                    found |= names
                u = above[link[u]]
        return starts, ends, found, longest


def item_shards(bench: DataFrame, item_id: str, text: str, window: int, shard_words: int):
    """Yield lists of (item id, words), each of about ``shard_words`` words;
    one is held by the driver at a time."""
    def pieces(batch):
        rows = []
        for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(t)
            step = PIECE_WORDS - (window - 1) if len(words) > PIECE_WORDS else max(len(words), 1)
            for k in range(0, max(len(words) - (window - 1), 1) if step < len(words) else min(len(words), 1), step):
                piece = words[k:k + PIECE_WORDS] if step < len(words) else words
                rows.append((name, b" ".join(piece), len(piece)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                          pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array([r[2] for r in rows], pa.int64())], ["item", "piece", "n"])
    src = bench.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    cut = stage_table(map_batches(src, pieces, "item string, piece binary, n long"), "items")
    total = cut.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    for k in range(shards):
        part = cut.where(F.pmod(F.xxhash64("item", "piece"), F.lit(shards)) == k)
        yield [(r.item, bytes(r.piece).split()) for r in part.collect()]


_OUT = ("n_words long, n_hit long, longest long, items array<string>, "
        "spans array<struct<start:int,end:int>>")


def find_contamination(docs: DataFrame, bench: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = 10,
                       shard_words: int = 50_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns in ``keep``, n_words,
    n_hit (words inside an occurrence of a window), longest (longest match,
    in words), items (ids of items with an occurring window, sorted) and
    spans (hit word runs [start, end), in order)."""
    cols = [doc_id, *[k for k in dict.fromkeys((*keep, text)) if k != doc_id]]
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    out = docs.select(*cols)
    own = _OUT.split(", ")
    for k, items in enumerate(item_shards(bench, item_id, item_text, window, shard_words)):
        if k:
            out = stage_table(out, "hits")           # one scan and one broadcast per shard of items
        auto = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(items, window))

        def scan(batch, auto=auto, first=k == 0):
            sa = auto.value
            n_words, longest, names, spans = [], [], [], []
            prior = batch.schema.names
            for i, t in enumerate(batch.column(prior.index(text))):
                words = words_of(t.as_py())
                s, e, found, most = sa.scan(words)
                if not first:
                    was = batch.column(prior.index("_spans"))[i].as_py()
                    s += [x["start"] for x in was]
                    e += [x["end"] for x in was]
                    found |= set(batch.column(prior.index("_items"))[i].as_py())
                    most = max(most, batch.column(prior.index("_longest"))[i].as_py())
                found.discard(None)
                a, b = merge_runs(np.array(s, np.int64), np.array(e, np.int64))
                n_words.append(len(words))
                longest.append(most)
                names.append(sorted(found))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
            hit = [sum(x["end"] - x["start"] for x in r) for r in spans]
            made = [pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()), pa.array(longest, pa.int64()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            kept = [batch.column(j) for j in range(len(cols))]
            yield pa.RecordBatch.from_arrays(kept + made, [*cols, *["_" + x.split()[0] for x in own]])
        schema = ", ".join([*[f"`{c}` {kind[c]}" for c in cols], *["_" + x for x in own]])
        out = map_batches(out, scan, schema)
    wanted = [doc_id, *[k for k in dict.fromkeys(keep) if k != doc_id]]
    return out.select(*[F.col(f"`{c}`") for c in wanted if c not in {x.split()[0] for x in own}],
                      *[F.col("_" + x.split()[0]).alias(x.split()[0]) for x in own])


def _cut(text: str | None, spans) -> str | None:
    """The text without the given word runs (and what lies between their
    words); what is left is joined by one space at each cut."""
    if text is None or not spans:
        return text
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    low = np.where((raw >= 0x41) & (raw <= 0x5A), raw + 32, raw).astype(np.uint8)
    s, e, _ = word_spans(low, np.array([0, len(raw)]), ALNUM)
    parts, at = [], 0
    for x in spans:
        parts.append(raw[at:s[x["start"]]].tobytes())
        at = e[x["end"] - 1]
    parts.append(raw[at:].tobytes())
    left = [p.decode("utf-8", "surrogatepass").strip() for p in parts]
    return " ".join(p for p in left if p)


def remove_contamination(docs: DataFrame, bench: DataFrame, *, max_coverage: float = 0.5, min_span: int = 1,
                         doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None,
                         **options) -> DataFrame:
    """``docs`` (same columns) without benchmark passages: hit runs of at
    least ``min_span`` words are cut out of the text, and a document is
    dropped when more than ``max_coverage`` of its words are hit.  Documents
    without such a run stay as they are.  ``n_chars`` names a column to hold
    the new text length of changed documents."""
    cols = docs.columns
    hits = find_contamination(docs.withColumns({f"_c{i}": F.col(f"`{c}`") for i, c in enumerate(cols)}), bench,
                              doc_id=doc_id, text=text, keep=tuple(f"_c{i}" for i in range(len(cols))), **options)
    left = hits.where(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words")).withColumn(
        "_cut", F.filter("spans", lambda x: x["end"] - x["start"] >= min_span))
    at = f"_c{cols.index(text)}"

    def clean(batch):
        names = batch.schema.names
        new = [_cut(t, x) for t, x in zip(batch.column(names.index(at)).to_pylist(),
                                          batch.column(names.index("_cut")).to_pylist())]
        yield pa.RecordBatch.from_arrays([*[batch.column(names.index(f"_c{i}")) for i in range(len(cols))],
                                          pa.array(new, pa.string())],
                                         [*[f"_c{i}" for i in range(len(cols))], "_new"])
    kept = left.select(*[f"_c{i}" for i in range(len(cols))], "_cut")
    schema = ", ".join([*[f"_c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(cols)],
                        "_new string"])
    done = map_batches(kept, clean, schema)
    final = {c: F.col(f"_c{i}") for i, c in enumerate(cols)}
    final[text] = F.col("_new")
    if n_chars in cols:
        kind = docs.schema[n_chars].dataType
        changed = ~F.col("_new").eqNullSafe(F.col(at))
        final[n_chars] = F.when(changed, F.length("_new").cast(kind)).otherwise(final[n_chars])
    return done.select(*[final[c].alias(c) for c in cols])
