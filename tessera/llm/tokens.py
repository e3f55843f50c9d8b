"""Token ids as Parquet list columns.

``write_tokens`` range-partitions the documents by id, tokenises each
partition and writes it sorted, one file per partition: a row has the id,
the number of tokens and the list of ids (dictionary encoded: a vocabulary
below 65,536 entries takes 16 bits an id before compression; Parquet's
delta encoding serves the ascending columns).  Row groups and pages are of
controlled size and pages are indexed, so that a reader of a few documents
or of the metadata alone skips the rest.  ``read_tokens`` gives the rows
with their place in the whole sequence of ids.

Only the text is shuffled, never the ids.  A task memorises the ids of words
it has met (at most ``MEMO_WORDS``), which changes the time and not the ids.

Defined results: null and empty texts have the end id only; rows with equal
ids stay, in no set order among them; a null id sorts first; other columns
are ignored unless named in ``keep``.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACES, freeing, partitions, row_of, sliced, span_hash, prefix_hash, byte_values, \
    text_bytes, word_spans

MEMO_WORDS = 1_000_000
#: ASCII marks that stand at the end of a word and never join it; no
#: apostrophe, since the vocabulary has contractions.
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,!?%*#$&;:")] = True
_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True


class WordMemo:
    """Ids of words met before: a fixed table in which a word's hash has two
    slots, and for each slot the place of the word's ids in one flat array.
    A word that finds both slots taken is encoded again each time."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.mask = np.uint64((1 << max(1, (MEMO_WORDS - 1).bit_length())) - 1)
        slots = int(self.mask) + 1
        self.hash = np.zeros(slots, np.uint64)        # 0: free
        self.start = np.zeros(slots, np.int32)
        self.size = np.zeros(slots, np.int32)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _add(self, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(max(len(ids), self.used), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def look_up(self, hashes: np.ndarray, word: Callable[[np.ndarray], list[str]]):
        """(ids, start, size) of each word by its hash; ``word`` gives the
        words at some of the places."""
        h = np.where(hashes == 0, np.uint64(1), hashes)
        one = (h & self.mask).astype(np.int64)
        miss = np.flatnonzero(self.hash[one] != h)
        two = ((h[miss] >> np.uint64(40)) & self.mask).astype(np.int64)
        one[miss] = two
        miss = miss[self.hash[two] != h[miss]]
        keep = self.used
        if not len(miss):
            return self.ids, self.start[one], self.size[one]
        new, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
        ids, sizes = self.encode(word(miss[at]))
        starts = self.used + np.cumsum(sizes) - sizes
        self._add(ids)
        start, size = self.start[one], self.size[one]
        start[miss], size[miss] = starts[back], sizes[back]
        flat, stored = self.ids, np.zeros(len(new), bool)
        for slot in ((new & self.mask).astype(np.int64), ((new >> np.uint64(40)) & self.mask).astype(np.int64)):
            left = np.flatnonzero(~stored & (self.hash[slot] == 0))
            _, first = np.unique(slot[left], return_index=True)
            put = left[first]
            self.hash[slot[put]], self.start[slot[put]], self.size[slot[put]] = new[put], starts[put], sizes[put]
            stored[put] = True
        if not stored.any():                          # a full table: do not keep what nothing points at
            self.used = keep
        return flat, start, size


def word_encoder(path: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Words to (all ids, number of ids of each word)."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)

    def encode(words):
        e = tok.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(e.ids, np.int32), np.bincount(np.array(e.word_ids, np.int64), minlength=len(words))
    return encode


_memos: dict = {}


def _memo(tokenizer: str, encoder) -> WordMemo:
    """One memo for all tasks that a Python worker runs."""
    key = (tokenizer, encoder.__module__, encoder.__qualname__)
    if key not in _memos:
        _memos[key] = WordMemo(encoder(tokenizer))
    return _memos[key]


def tokenise(texts: pa.Array, memo: WordMemo) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number of ids of each text).  A text is cut at white space,
    and before closing marks that follow an ASCII letter or digit; neither
    this vocabulary's normal form nor its words reach over such a cut."""
    raw, offs = text_bytes(texts)
    if b"<|" not in raw.tobytes():                    # else a special token could come of lower-casing
        raw = LOWER[raw]
    s, e, first = word_spans(raw, offs, SPACES)
    if not len(s):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    # last byte before the word's closing marks
    solid = np.where(_TAIL[raw], -1, np.arange(len(raw)))
    core = np.maximum.accumulate(solid)[e - 1] + 1
    cut = (core > s) & (core < e)
    cut[cut] = _ASCII_WORD[raw[core[cut] - 1]]
    # words in order, the closing marks of a word behind it
    at = np.arange(len(s)) + np.cumsum(cut) - cut
    begin = np.empty(len(s) + int(cut.sum()), np.int64)
    end, row = np.empty_like(begin), np.empty_like(begin)
    begin[at], end[at], row[at] = s, np.where(cut, core, e), row_of(first)
    tail = at[cut] + 1
    begin[tail], end[tail], row[tail] = core[cut], e[cut], row[at[cut]]
    data = raw.tobytes()
    ids, start, n = memo.look_up(span_hash(prefix_hash(byte_values(raw)), begin, end), lambda new: [
        data[a:b].decode() for a, b in zip(begin[new].tolist(), end[new].tolist())])
    n = n.astype(np.int64)
    shift = np.cumsum(n) - n
    out = ids[np.repeat(start - shift, n) + np.arange(int(n.sum()))]
    return out, np.bincount(row, weights=n, minlength=len(texts)).astype(np.int64)


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int | None = 2, doc_id: str = "doc_id",
                 text: str = "text", keep: Sequence[str] = (), encoder=word_encoder,
                 row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000,
                 compression: str = "zstd") -> str:
    """Write (doc_id, *keep, n_tokens, ids) in ascending doc_id order to
    ``path``.  ``tokenizer`` is the vocabulary file's place on the workers;
    ``encoder(tokenizer)`` must give an encoder of white-space words."""
    cols = [doc_id, *keep]
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    ranged = (docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*cols, text])])
              .repartitionByRange(partitions(docs), F.col(f"`{doc_id}`")).sortWithinPartitions(F.col(f"`{doc_id}`")))

    def run(batches):
        memo = _memo(tokenizer, encoder)
        tail = [] if end_id is None else [end_id]
        for whole in batches:
            for b in sliced(whole):
                ids, sizes = tokenise(b.column(b.schema.names.index(text)), memo)
                if tail:
                    ids = np.insert(ids, np.cumsum(sizes), end_id).astype(np.int32)
                    sizes = sizes + 1
                offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i) for i in range(len(cols))], pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(ids))], [*cols, "n_tokens", "ids"])
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in cols], "n_tokens long", "ids array<int>"])
    (ranged.mapInArrow(freeing(run), schema).write.option("compression", compression)
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows).option("parquet.enable.dictionary", "true")
     .option("parquet.writer.version", "PARQUET_2_0").parquet(path))
    return path


def token_index(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, file, row): the place of each document in
    the sequence of all ids, read from the metadata columns alone."""
    rows = spark.read.parquet(path).select(F.col(f"`{doc_id}`"), "n_tokens", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    return _placed(rows, rows)


def _placed(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add each row's start; ``sizes`` has (file, n_tokens) of all rows."""
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy("file").agg(F.sum("n_tokens").alias("_sum")).select(
        "file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))   # one row per file
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(files, "file").withColumn(
        "start", F.col("_offset") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).drop("_offset"))


def token_digest(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the written files: crc32 of
    a document's ids as little-endian unsigned 32-bit integers."""
    files = spark.read.parquet(path)
    kind = files.schema[doc_id].dataType.simpleString()
    src = files.select(F.col(f"`{doc_id}`"), F.col("_metadata.file_name").alias("file"),
                       F.col("_metadata.row_index").alias("row"), "ids")

    def run(batches):
        for b in batches:
            col = b.column(3)
            flat = np.asarray(col.values).astype("<u4")
            offs = np.asarray(col.offsets)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(offs), pa.int64()),
                 pa.array([zlib.crc32(flat[x:y].tobytes()) for x, y in zip(offs[:-1], offs[1:])], pa.int64())],
                [doc_id, "file", "row", "n_tokens", "ids_crc32"])
    rows = src.mapInArrow(freeing(run), f"`{doc_id}` {kind}, file string, row long, n_tokens long, ids_crc32 long")
    sizes = files.select(F.col("_metadata.file_name").alias("file"), "n_tokens")
    return _placed(rows, sizes).select(F.col(f"`{doc_id}`"), "start", "n_tokens", "ids_crc32")
