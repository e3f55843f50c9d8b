"""Toxicity scores by FTRL-proximal logistic regression over hashed words,
word bigrams and skip-grams.

Training takes a bounded sample of the labelled rows (``sample_rows``, by
hash of the id; all of them when there are fewer).  The sample is dealt over
a fixed number of shards; in each round every shard runs FTRL over its rows
from the same state, and one task averages the shards' states, whose size is
set by ``bits`` alone, into a table that the next round reads.  Per-coordinate rates come from the summed squared
gradients, and the L1 term leaves a few thousand weights that are not zero:
these are broadcast, and every document is scored in one scan without a
shuffle.

A feature counts once per document.  Words are runs of ASCII letters, digits
and bytes beyond ASCII; A-Z is lower-cased.  Ids, labels, language and source
are never features.

Defined results: null and empty texts get the score of the intercept;
labelled rows without a document or with a null label are not used; without
any usable label the score is 0.5 throughout; repeated rows are scored alike;
other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, map_batches, mix, row_of, sliced, stage_table, starts_with_room, text_bytes, \
    word_hashes


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each word, bigram and skip-gram; with repeats."""
    raw, offs = text_bytes(texts)
    h, _, _, first = word_hashes(LOWER[raw], offs, ALNUM)
    row, keep = row_of(first), np.uint64((1 << bits) - 1)
    parts = [(row, h)]
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            at = np.flatnonzero(starts_with_room(first, gap + 1))
            parts.append((row[at], mix(h[at] * np.uint64(3) + h[at + gap], gap)))
    return np.concatenate([p[0] for p in parts]), (np.concatenate([p[1] for p in parts]) & keep).astype(np.int64)


class Ftrl:
    """State and weights of FTRL-proximal; coordinate 2^bits is the intercept."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n, self.alpha, self.beta, self.l1, self.l2 = z, n, alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One example, whose distinct active coordinates are ``at``."""
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


_STATE = "z binary, n binary"


def _state_row(m: Ftrl) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in (m.z, m.n)],
                                      ["z", "n"])


def _average(batches):
    rows = sorted((z, n) for b in batches for z, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    if rows:
        yield _state_row(Ftrl(*(sum(np.frombuffer(r[i], "<f4").astype(np.float64) for r in rows) / len(rows)
                                for i in (0, 1)), 1.0, 1.0, 1.0, 1.0))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(rows: DataFrame, *, bits: int = 20, shards: int = 4, rounds: int = 6, alpha: float = 2.0,
          beta: float = 1.0, l1: float = 2.0, l2: float = 0.1) -> np.ndarray:
    """Weights (2^bits + 1) from rows (key, text, label); ``rows`` is a
    bounded sample.  The order within a shard follows the key's hash, so a
    second run gives the same weights."""
    size, wide = (1 << bits) + 1, bits + 1
    sample = stage_table(rows.select(F.xxhash64(F.col("key").cast("string"), F.col("text")).alias("_h"), "text",
                                     F.col("label").cast("int").alias("label")), "sample")
    none = F.lit(None).cast("binary")
    state = None

    def learn(batches):
        """Rows come by shard, the shard's state before its examples."""
        model = shard = None
        for whole in batches:
            for b in sliced(whole):
                shards_, labels = b.column(0).to_pylist(), b.column(3).to_pylist()
                states = [b.column(k) for k in (4, 5)]
                row, at = features(b.column(2), bits)
                both = np.unique(row << wide | at)
                cuts = np.searchsorted(both >> wide, np.arange(b.num_rows + 1))
                at = both & ((1 << wide) - 1)
                for i, y in enumerate(labels):
                    if shards_[i] != shard:
                        if model is not None:
                            yield _state_row(model)
                        shard, model = shards_[i], Ftrl(np.zeros(size), np.zeros(size), alpha, beta, l1, l2)
                    if y is None:
                        model.z, model.n = (np.frombuffer(x[i].as_py(), "<f4").astype(np.float64) for x in states)
                    else:
                        model.learn(np.append(at[cuts[i]:cuts[i + 1]], size - 1), y)
        if model is not None:
            yield _state_row(model)

    for k in range(rounds):
        shard = F.pmod("_h", F.lit(shards))
        examples = sample.select(shard.alias("shard"), F.xxhash64("_h", F.lit(k)).alias("turn"), "text", "label",
                                 none.alias("z"), none.alias("n"), "_h")
        if state is not None:
            before = state.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias(
                "shard"),
                                  F.lit(-2 ** 63).cast("long").alias("turn"), F.lit(None).cast("string").alias("text"),
                                  F.lit(None).cast("int").alias("label"), "z", "n", F.lit(0).cast("long").alias("_h"))
            examples = examples.unionByName(before)
        dealt = examples.repartition(shards, "shard").sortWithinPartitions(
            "shard", F.col("label").isNotNull(), "turn", "_h").drop("_h")
        state = stage_table(dealt.mapInArrow(learn, _STATE).repartition(1).mapInArrow(_average, _STATE), "state")

    def weigh(batches):
        for b in batches:
            for z, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = Ftrl(*(np.frombuffer(x, "<f4").astype(np.float64) for x in (z, n)), alpha, beta, l1, l2).weights()
                at = np.flatnonzero(w)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at])], ["at", "w"])
    out = np.zeros(size)
    if state is not None:
        for at, w in state.mapInArrow(weigh, "at int, w double").collect():     # the weights that are not zero
            out[at] = w
    return out


def training_sample(docs: DataFrame, labels: DataFrame, *, label: str, usable: Column, sample_rows: int = 20_000,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """At most about ``sample_rows`` labelled documents (key, text, label).
    Their ids are a broadcast of that bounded size; no text is shuffled."""
    known = labels.select(F.col(f"`{doc_id}`").alias("key"), F.col(f"`{label}`").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("key").agg(F.max("label").alias("label")).where(usable)
    total = known.count()
    if total > sample_rows:
        known = known.where(F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) < int(sample_rows / total * (1 << 30)))
    return docs.select(F.col(f"`{doc_id}`").alias("key"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(known), "key")


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with ``column`` (an existing column of that name is replaced)."""
    bits = (len(weights) - 1).bit_length() - 1
    at = np.flatnonzero(weights)
    sparse = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at], len(weights)))
    cols = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)])
    where = cols.index(text)

    def run(batch):
        at, w, size = sparse.value
        dense = np.zeros(size)
        dense[at] = w
        row, f = features(batch.column(where), bits)
        hit = dense[f] != 0
        both = np.unique(row[hit] << (bits + 1) | f[hit])
        total = np.bincount(both >> (bits + 1), weights=dense[both & ((1 << (bits + 1)) - 1)],
                            minlength=batch.num_rows) + dense[size - 1]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(cols))], pa.array(sigmoid(total))],
                                         [*[f"_c{i}" for i in range(len(cols))], "_score"])
    schema = ", ".join([*[f"_c{i} {docs.schema[i].dataType.simpleString()}" for i in range(len(cols))],
                        "_score double"])
    out = map_batches(named, run, schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols) if c != column],
                      F.col("_score").alias(column))


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
