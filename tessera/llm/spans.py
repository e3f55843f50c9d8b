"""Windows of fixed length that repeat across documents: the frame that the
substring operators share.

A window belongs to its anchor, the gram in it whose hash is least.  Equal
windows have equal anchors, so all copies of a window meet in one shard, and
no shard needs to see another's text.  Consecutive windows with one anchor
form a segment.

Copies of a whole text are set aside first, since all their windows repeat.

1. Each window holds its anchor and the units on the anchor's longer side up
   to half of its other units.  These wider grams are counted by a hash of
   ``bits`` bits, each once per document; those that occur in two documents are
   set in a bit map of that size, a bounded broadcast whose false positives
   cost time only.  Tasks send sorted places by block of the map.
2. A second scan cuts the segments that hold such a gram.  Each distinct segment
   is kept once with its smallest id (copies collapse before and in the
   shuffle); its occurrences are slim rows of their own.
3. Shards of about ``SHARD_SEGMENTS`` distinct segments go to an engine, which
   finds for every window the smallest id it starts in.
4. The answers are joined to the occurrences, a part of the segments after the
   other, and the windows whose smallest id is below the document's own are
   marked.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, SPACES, U64, byte_values, freeing, merge_runs, mix, prefix_hash, row_of, sliced, \
    sliding_argmin, span_hash, stage_table, starts_with_room, text_bytes, word_hashes

SHARD_SEGMENTS = 15_000
#: Places of the bit map that a task holds before it sends them.
HELD_PLACES = 1 << 21
#: Parts of the segments whose answers are joined one after the other.
PASSES = 3
#: Segments whose content a task remembers to have sent.
SEEN_SEGMENTS = 300_000
#: Ids that may be broadcast (8 bytes each); more are joined.
BROADCAST_IDS = 2_000_000
#: Stands for all windows of a document.
EVERY = -1
#: A run [a, b) of windows travels as one long, a * RUN + b.
RUN = 1 << 32
#: (sid, own smallest id, content) of a shard -> for each segment the smallest id of each of its windows
Engine = Callable[[list[bytes], np.ndarray], list[np.ndarray]]


class Units:
    """The units of a slice of texts (words or bytes), and its segments."""

    def __init__(self, texts: pa.Array, words: bool, window: int, gram: int):
        raw, offs = text_bytes(texts)
        self.raw, self.window, self.words = raw, window, words
        if words:
            h, self.start, self.end, self.first = word_hashes(raw, offs, SPACES)
        else:
            h, self.first = byte_values(raw), offs
            self.start = np.arange(len(raw))
            self.end = self.start + 1
        n = len(h)
        self.anchor = self.begin = self.stop = self.row = np.zeros(0, np.int64)
        self.key = self.left = self.right = np.zeros(0, U64)
        self.has_left = self.has_right = np.zeros(0, bool)
        if n < window:
            return
        at = np.arange(n - gram + 1)
        prefix = prefix_hash(h)
        grams = span_hash(prefix, at, at + gram)
        least = sliding_argmin(grams, window - gram + 1)           # n - window + 1 windows
        real = np.flatnonzero(starts_with_room(self.first, window)[:len(least)])
        if not len(real):
            return
        anchor = least[real]
        new = np.ones(len(real), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (real[1:] != real[:-1] + 1)
        last = np.flatnonzero(np.append(new[1:], True))
        self.begin = real[new]                                     # first window of each segment
        self.stop = real[last] + window                            # end of its units
        self.key = grams[anchor[new]]
        self.row = row_of(self.first)[self.begin]
        # a window has ``side`` units before its anchor, or else ``rest`` after it
        side = (window - gram + 1) // 2
        rest, a = window - gram - side + 1, anchor[new]
        self.has_left, self.has_right = a - self.begin >= side, a - real[last] < side
        self.left = span_hash(prefix, a - np.where(self.has_left, side, 0), a + gram)
        self.right = mix(span_hash(prefix, a, a + gram + np.where(self.has_right, rest, 0)), 5)

    def places(self, bits: int) -> np.ndarray:
        """Places in the bit map of the slice's wider grams, once per document."""
        key = np.concatenate([self.left[self.has_left], self.right[self.has_right]])
        row = np.concatenate([self.row[self.has_left], self.row[self.has_right]])
        return np.unique(_bit(key, bits) << 24 | row) >> 24

    def shared(self, bit_map: np.ndarray, bits: int) -> np.ndarray:
        """The segments that hold a gram whose place is set."""
        def is_set(key):
            at = _bit(key, bits)
            return (bit_map[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return np.flatnonzero(self.has_left & is_set(self.left) | self.has_right & is_set(self.right))

    def content(self, k: np.ndarray) -> list[bytes]:
        data = self.raw.tobytes()
        return [data[a:b] for a, b in zip(self.start[self.begin[k]].tolist(), self.end[self.stop[k] - 1].tolist())]

    def segment_hash(self) -> np.ndarray:
        """Hash of each segment's units."""
        values = word_values(self) if self.words else byte_values(self.raw)
        return span_hash(prefix_hash(values), self.begin, self.stop)


def word_values(u: Units) -> np.ndarray:
    return span_hash(prefix_hash(byte_values(u.raw)), u.start, u.end)


def _bit(key: np.ndarray, bits: int) -> np.ndarray:
    return (mix(key, 77) >> U64(64 - bits)).astype(np.int64)


def _slices(batches, words: bool):
    """Slices of a task's batches; one of bytes has as many units as bytes."""
    for whole in batches:
        yield from sliced(whole, SLICE_BYTES if words else SLICE_BYTES // 8)


def _packed(at: np.ndarray) -> bytes:
    """Ascending places by their steps."""
    return zlib.compress(np.diff(at, prepend=0).astype(np.uint32).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.int64))


def _shared_grams(docs: DataFrame, words: bool, window: int, gram: int, bits: int) -> np.ndarray:
    """Packed bit map of the wider grams that occur in two documents or more."""
    block = 1 << max(3, bits - 6)

    def send(held):
        at, n = np.unique(np.concatenate(held), return_counts=True)
        rows = []
        for k in np.unique(at // block).tolist():
            a, b = np.searchsorted(at, (k * block, (k + 1) * block))
            own, many = at[a:b] - k * block, n[a:b] > 1
            rows.append((k, _packed(own[~many]), _packed(own[many])))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))],
                                          ["block", "once", "many"])

    def count(batches):
        held, size = [], 0
        for batch in _slices(batches, words):
            at = Units(batch.column(0), words, window, gram).places(bits)
            held.append(at.astype(np.int32))
            size += len(at)
            if size >= HELD_PLACES:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    def pack(batches):
        block_no, n = None, None                                   # one block of the map at a time
        def done():
            return pa.RecordBatch.from_arrays([pa.array([block_no], pa.int32()),
                                               pa.array([np.packbits(n > 1).tobytes()])], ["block", "map"])
        for b in batches:
            for k, once, many in zip(*(b.column(j).to_pylist() for j in range(3))):
                if k != block_no:
                    if n is not None:
                        yield done()
                    block_no, n = k, np.zeros(block, np.uint8)
                n[_unpacked(many)] = 2
                once = _unpacked(once)
                n[once] = np.minimum(n[once] + 1, 2)
        if n is not None:
            yield done()
    # the places of a block meet in one task, so that no task makes more of the map than it is dealt
    sent = docs.select("text").mapInArrow(freeing(count), "block int, once binary, many binary")
    maps = sent.repartition(16, "block").sortWithinPartitions("block").mapInArrow(freeing(pack), "block int, map binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in maps.collect():
        out[r.block * (block // 8):(r.block + 1) * (block // 8)] = np.frombuffer(r.map, np.uint8)
    return out


def _without_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first document of each text, and the rids of its copies with
    larger ids, whose windows all repeat."""
    sig = [F.xxhash64("text").alias("_s0"), F.xxhash64(F.lit(1), "text", F.length("text")).alias("_s1")]
    sigs = docs.where("text IS NOT NULL").select("id", "rid", *sig)
    least = sigs.groupBy("_s0", "_s1").agg(F.min("id").alias("_least"))
    copies = stage_table(sigs.join(least, ["_s0", "_s1"]).where("id > _least").select("rid").distinct(), "copies")
    if copies.count() > BROADCAST_IDS:                # the other way, for any size
        return docs.join(copies, "rid", "left_anti").select("id", "rid", "text"), copies
    known = docs.sparkSession.sparkContext.broadcast(np.sort(copies.toPandas()["rid"].to_numpy(np.int64)))

    def first(batches):
        for b in batches:
            rid = np.asarray(b.column(1))
            at = np.minimum(np.searchsorted(known.value, rid), max(len(known.value) - 1, 0))
            copy = known.value[at] == rid if len(known.value) else np.zeros(len(rid), bool)
            yield b.filter(pa.array(~copy))
    return docs.select("id", "rid", "text").mapInArrow(freeing(first), "id long, rid long, text string"), copies


def marked_windows(docs: DataFrame, engine: Engine, *, words: bool, window: int, gram: int) -> DataFrame:
    """(rid, runs): for rows (id long, rid long, text) the runs of windows that
    also start in a document with a smaller id; rows without any are absent."""
    docs, copies = _without_copies(docs.where("id IS NOT NULL"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(min(30, max(16, (total // (4 if words else 2)).bit_length())))
    shared = docs.sparkSession.sparkContext.broadcast(_shared_grams(docs, words, window, gram, bits))

    def cut(batches):
        seen: dict[int, int] = {}                         # smallest id sent with a content, by segment
        for batch in _slices(batches, words):
            u = Units(batch.column(2), words, window, gram)
            if not len(u.begin):
                continue
            hit = u.shared(shared.value, bits)
            if not len(hit):
                continue
            sid = u.segment_hash()[hit].view(np.int64)
            ids = np.asarray(batch.column(0))[u.row[hit]]
            order = np.lexsort((ids, sid))
            lead = order[np.concatenate([[True], sid[order][1:] != sid[order][:-1]])]   # smallest id of each
            was = [seen.get(x) for x in sid[lead].tolist()]
            content = np.full(len(hit), None, object)
            again = np.array([w is not None for w in was], bool)
            lower = lead[[w is not None and i < w for w, i in zip(was, ids[lead].tolist())]]
            content[lower] = b""                      # a smaller id of a content sent before
            content[lead[~again]] = u.content(hit[lead[~again]])
            if len(seen) < SEEN_SEGMENTS:
                seen.update(zip(sid[lead[~again]].tolist(), ids[lead[~again]].tolist()))
            seen.update(zip(sid[lower].tolist(), ids[lower].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid), pa.array(u.key[hit].view(np.int64)), pa.array(ids),
                 batch.column(1).take(pa.array(u.row[hit])),
                 pa.array((u.begin[hit] - u.first[u.row[hit]]).astype(np.int32)), pa.array(content, pa.binary())],
                ["sid", "anchor", "id", "rid", "start", "content"])
    cuts = stage_table(docs.select("id", "rid", "text").mapInArrow(
        freeing(cut), "sid long, anchor long, id long, rid long, start int, content binary"), "segments")
    contents = cuts.where("content IS NOT NULL")          # about one row a task and segment, with its smallest id
    shards = max(1, -(-contents.count() // SHARD_SEGMENTS))

    def run(part):
        sid, anchor, ids = (part.column(c).to_numpy() for c in ("sid", "anchor", "id"))
        order = np.lexsort((anchor, sid))
        new = np.ones(len(order), bool)
        new[1:] = (sid[order][1:] != sid[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        full = pc.binary_length(part.column("content")).to_numpy()[order] > 0
        group, lead = np.unique((np.cumsum(new) - 1)[full], return_index=True)
        lead = order[full][lead]                          # one row with its content of each segment
        runs, mins, n = equal_runs(engine(part.column("content").take(pa.array(lead)).to_pylist(), least[group]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        return pa.table({"sid": sid[lead], "anchor": anchor[lead], "runs": pa.ListArray.from_arrays(offsets, pa.array(runs)),
                         "mins": pa.ListArray.from_arrays(offsets, pa.array(mins))})
    answers = stage_table(contents.select("sid", "anchor", "id", "content").groupBy(
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")).applyInArrow(
        run, "sid long, anchor long, runs array<long>, mins array<long>"), "answers")
    # a part of the segments at a time, so that no more than a part's shuffle lies on disk beside the tables
    marks = copies.select("rid", F.array(F.lit(EVERY)).alias("runs"))
    for k in range(PASSES):
        part = F.pmod(F.xxhash64("sid"), F.lit(PASSES)) == k
        met = cuts.where(part).select("sid", "anchor", "id", "rid", "start").join(
            answers.where(part), ["sid", "anchor"]).where(F.col("id") > F.array_min("mins"))
        runs = F.transform(F.filter(F.arrays_zip("runs", "mins"), lambda s: s["mins"] < F.col("id")),
                           lambda s: s["runs"] + F.col("start") * F.lit(RUN + 1))
        marks = marks.unionByName(stage_table(met.select("rid", runs.alias("runs")).groupBy("rid").agg(
            F.flatten(F.collect_list("runs")).alias("runs")), "marks"))                # within one document
    return marks.groupBy("rid").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def equal_runs(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs [a, b) of equal values in each part, as a * ``RUN`` + b, the
    values of the runs, and how many runs each part has."""
    size = np.array([len(m) for m in parts], np.int64)
    flat, first = np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64), np.cumsum(size) - size
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[first[size > 0]] = True
    a = np.flatnonzero(new)
    part = np.repeat(np.arange(len(size)), size)[a]
    return ((a - first[part]) * RUN + np.append(a[1:], len(flat)) - first[part], flat[a],
            np.bincount(part, minlength=len(size)))


def expand(runs: list[int] | None) -> np.ndarray:
    """The window starts of runs, each once, ascending; ``EVERY`` stays."""
    if not runs:
        return np.zeros(0, np.int64)
    if EVERY in runs:
        return np.array([EVERY], np.int64)
    return np.unique(np.concatenate([np.arange(*divmod(r, RUN)) for r in runs])).astype(np.int64)


def remove_marked(docs: DataFrame, marks: DataFrame, cut: Callable, schema: str) -> DataFrame:
    """``cut(text bytes, start, end)`` (merged unit runs) for each row of
    (id, rid, text), after a join with its marked windows."""
    def run(batches):
        for whole in batches:
            for b in sliced(whole):
                texts, runs = b.column(1), b.column(2).to_pylist()
                raw, offs = text_bytes(texts)
                data = raw.tobytes()
                rows = [cut(data[offs[i]:offs[i + 1]], expand(r)) for i, r in enumerate(runs)]
                fields = [f.split() for f in schema.split(", ")]
                kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
                         "array<array<long>>": pa.list_(pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array([r[k] for r in rows], kinds[f[1]]) for k, f in enumerate(fields)]],
                    ["id", *[f[0] for f in fields]])
    kind = docs.schema["id"].dataType.simpleString()
    both = docs.join(marks.withColumnRenamed("rid", "_rid"), F.col("rid") == F.col("_rid"), "left")
    return both.select("id", "text", "runs").mapInArrow(freeing(run), f"id {kind}, {schema}")


def prepare(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, rid, text): rid tells rows apart by id and text."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).select(
        "id", F.xxhash64("id", "text").alias("rid"), "text")
