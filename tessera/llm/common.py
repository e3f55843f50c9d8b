"""Helpers shared by the operators: tasks over Arrow batches, word and byte
hashing in numpy, and stage tables in the cluster's shared folder."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

U64 = np.uint64
#: Bytes of text that one numpy pass holds at a time; a longer document is
#: still taken whole.
SLICE_BYTES = (1 << 20) - 4096
#: Spark's setting: a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables.  Arrow batches are kept small, since
    rows hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and
    executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later readers do
    not run the work again, and no lost executor loses it."""
    path, conf = shared_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")                 # the table is whole: its shuffle files are not read again
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator], schema: str) -> DataFrame:
    """``fn`` over each Arrow batch, sliced to at most ``SLICE_BYTES``."""
    def run(batches):
        for batch in batches:
            for part in sliced(batch):
                yield from fn(part)
    return df.mapInArrow(run, schema)


def freeing(run: Callable) -> Callable:
    """``run`` for mapInArrow; at the end of the task, what its arrays have left
    free goes back to the system, since an idle Python worker would keep it
    beside the next stage's."""
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):             # another C library
            pass
    return whole


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of its
    largest string column, and one row at least."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.zeros(n, np.int64)
    for i, f in enumerate(batch.schema):
        if pa.types.is_string(f.type) or pa.types.is_binary(f.type):
            sizes = np.maximum(sizes, np.diff(offsets_of(batch.column(i))))
    ends = np.cumsum(sizes)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def offsets_of(col: pa.Array) -> np.ndarray:
    return np.frombuffer(col.buffers()[1], np.int32, count=len(col) + 1, offset=4 * col.offset).astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the offset of each
    row in it (a null row is empty)."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) else b"")
    offs = offsets_of(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


# ------------------------------------------------------------------ hashing
_MUL = U64(0x9E3779B97F4A7C15)
_ROOT = U64(0xD6E8FEB86659FD93)                       # odd, so it has an inverse modulo 2^64
_INV = U64(pow(int(_ROOT), -1, 1 << 64))
_powers: list = []                                    # one pair of tables, as large as was needed


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Splitmix finaliser of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x.astype(U64) + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_BYTE = mix(np.arange(256, dtype=U64), 7)             # a random 64-bit value for each byte


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0][0]) < n:
        pair = _power_pair(1 << max(16, int(n - 1).bit_length()))
        if n > 2 * SLICE_BYTES:                       # an oversized document: do not keep its tables
            return pair
        _powers[:] = [pair]
    return _powers[0]


def _power_pair(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for base in (_ROOT, _INV):
            p = np.ones(size, U64)
            done = 1
            while done < size:
                p[done:2 * done] = p[:done] * (p[done - 1] * base)
                done *= 2
            out.append(p)
    return out[0], out[1]


def prefix_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which ``span_hash`` reads the hash of any span of a
    sequence of 64-bit values in constant time."""
    up, down = _power_tables(len(values) + 1)
    acc = np.zeros(len(values) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[:len(values)], out=acc[1:])
    return acc, down


def span_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of the spans [start, end), which are at
    most as many as positions; of no use against an adversary."""
    acc, down = prefix
    with np.errstate(over="ignore"):
        return mix((acc[end] - acc[start]) * down[start] + (end - start).astype(U64) * _MUL)


def byte_values(raw: np.ndarray) -> np.ndarray:
    return _BYTE[raw]


def class_table(separators) -> np.ndarray:
    """256 flags: which bytes belong to words."""
    flags = np.ones(256, bool)
    flags[list(separators)] = False
    return flags


SPACES = class_table([0x20, *range(0x09, 0x0E)])      # [^\x20\x09-\x0D]+
ALNUM = class_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32                                # A-Z


def word_spans(raw: np.ndarray, offs: np.ndarray, flags: np.ndarray):
    """Words of each row: (start, end) byte offsets, and the index of each
    row's first word (one entry more than rows)."""
    n = len(raw)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = flags[raw]
    # a row border ends a word: mark the starts of rows as breaks
    step = np.diff(inside)
    start = step[:-1] == 1
    end = step[1:] == -1                              # last byte of a word
    cuts = offs[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    both = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)] if len(cuts) else cuts
    start[both] = True
    end[both - 1] = True
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def word_hashes(raw: np.ndarray, offs: np.ndarray, flags: np.ndarray):
    """(64-bit hash of every word, starts, ends, first word of each row)."""
    s, e, first = word_spans(raw, offs, flags)
    return span_hash(prefix_hash(byte_values(raw)), s, e), s, e, first


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each item, from the first item of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def starts_with_room(first: np.ndarray, k: int) -> np.ndarray:
    """Flags of the items at which k items of the same row begin."""
    total = int(first[-1])
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(total) + k <= last


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For each i the position of the (leftmost) least of h[i:i+w]."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, size = h, np.arange(len(h)), 1
    while size < w:
        hop = min(size, w - size)
        a, b = best[:-hop], best[hop:]
        right = b < a
        best = np.where(right, b, a)
        at = np.where(right, at[hop:], at[:-hop])
        size += hop
    return at[:n]


def merge_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the intervals [start, end): maximal runs, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    return s[new], e[np.flatnonzero(np.append(new[1:], True))]
