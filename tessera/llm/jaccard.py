"""Documents linked by the Jaccard similarity of their word n-grams, by a
token-group matrix.

1. Each document becomes a set of 64-bit n-gram hashes.  Documents with the
   same set are one node.
2. Similar nodes are partitioned into groups: nodes that share a min-hash
   come next to each other in a range sort, a node joins a leader near it
   when their exact similarity reaches the threshold, and the links of the
   ``SEEDS`` sorts are joined up.  A large family of linked near copies
   becomes one class here at a linear number of comparisons.  Nodes with the
   same min-hash form groups of about ``GROUP`` at most.
3. The token-group matrix has a row for each token of a group's union, as
   far as prefixes reach (in a common order, rare tokens first): two sets
   that reach the threshold share a token there.  Groups of the query's own
   class alone are left out at once.  A query and a group that share a token are a
   candidate.
4. The whole union of each such group is held as a bit map.  The query's
   bits that it lacks bound the overlap with every member; only groups whose
   bound reaches the threshold are opened.  There the members' own bit maps
   decide whether their sets are fetched, and then each is compared exactly.
5. Links between classes give the components.

No pairs are made within a class, so copies cost no more than their number,
while every link between different classes is found: the result is exact
(up to collisions of 64-bit n-gram hashes within a pair).

Scale: three scans for tokens; what is shuffled is a tenth of the tokens (as
hashes), the texts of nodes that share a min-hash, and the sets that are
opened.  Nodes that no candidate names are left out before their bit maps are
shuffled.  Broadcasts have a fixed size: counts per token bucket for the
order, and four bit maps, whose false positives cost time only.

Defined results: null and empty texts have the empty set and link with
nothing; rows that share an id count each by their text; ids may be of any
type that can be ordered; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, freeing, mix, partitions, sliced, stage_table, starts_with_room, text_bytes, \
    word_hashes
from .components import components

SEEDS = 3
LEADERS = 8
GROUP = 128
BUCKET_BITS = 16
BITMAP_BITS = 23


def ngrams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each n-gram of each text, first of each text).  A text of
    fewer words, but not none, has its whole sequence as the only one."""
    raw, offs = text_bytes(texts)
    h, _, _, first = word_hashes(LOWER[raw], offs, SPACES)
    words = np.diff(first)
    with np.errstate(over="ignore"):
        acc, at = h.copy(), np.arange(len(h))
        last = np.repeat(first[1:], words)
        for k in range(1, n):
            inside = at + k < last
            acc[inside] = mix(acc[inside] * np.uint64(5) + h[at[inside] + k], k)
        keep = starts_with_room(first, n)
        short = (words > 0) & (words < n)
        keep[first[:-1][short]] = True
        acc = np.where(np.repeat(short, words), mix(acc, 99), acc)
    count = np.where(short, 1, np.maximum(words - n + 1, 0))
    return acc[keep], np.concatenate([[0], np.cumsum(count)])


def set_of(h: np.ndarray) -> np.ndarray:
    s = np.sort(h)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def signature(s: np.ndarray) -> bytes:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        return np.array([mix(s, 21).sum(), mix(s, 22).sum() + np.uint64(len(s))], np.uint64).tobytes()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    same = overlap(a, b)
    return 100 * same >= percent * (len(a) + len(b) - same)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _longs(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _minhashes(s: np.ndarray) -> np.ndarray:
    """Keys under which similar sets meet, each from two min-hashes; then
    one min-hash."""
    m = np.array([mix(s, 31 + k).min() for k in range(SEEDS)], np.uint64)
    with np.errstate(over="ignore"):
        return np.append(mix(m * np.uint64(3) + np.roll(m, 1), 38), m[0])


def bits_of(s: np.ndarray) -> np.ndarray:
    """Bit map of a set's tokens: a power of two of bits, two a token or more."""
    size = 1 << max(6, int(2 * len(s) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(mix(s, 61) & np.uint64(size - 1)).astype(np.int64)] = True
    return bits


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The bit map that ``size`` bits would have given."""
    return bits.reshape(-1, size).any(axis=0)


def _unpack(raw: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)


# ------------------------------------------------------------------ bounded broadcasts
def token_weights(docs: DataFrame, n: int) -> np.ndarray:
    """Occurrences over all documents by bucket of the token hash."""
    size = 1 << BUCKET_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for whole in batches:
            for b in sliced(whole):
                h, _ = ngrams(b.column(0), n)
                total += np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])
    rows = docs.select("text").mapInArrow(freeing(count), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    got = rows.toPandas()                             # at most 2^BUCKET_BITS rows
    out[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bit map of 2^BITMAP_BITS for a column of longs."""
    block_bits = BITMAP_BITS - 6

    def blocks(batches):
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            bits = bit_of(np.asarray(b.column(0)))
            for k in np.unique(bits >> block_bits).tolist():
                m = maps.setdefault(k, np.zeros(1 << block_bits, bool))
                m[bits[bits >> block_bits == k] & ((1 << block_bits) - 1)] = True
        for k, m in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(m).tobytes()])],
                                             ["block", "map"])

    def merge(batches):
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            for k, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = np.frombuffer(m, np.uint8)
                maps[k] = maps[k] | m if k in maps else m
        for k, m in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([m.tobytes()])], ["block", "map"])
    kind = "block int, map binary"
    out = np.zeros((64, (1 << block_bits) // 8), np.uint8)
    for r in keys.select(column).mapInArrow(blocks, kind).repartition(16, "block").mapInArrow(merge, kind).collect():
        out[r.block] = np.frombuffer(r.map, np.uint8)
    return np.unpackbits(out.ravel()).astype(bool)


def bit_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64), 41) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


# ------------------------------------------------------------------ steps
def _sets(docs: DataFrame, n: int, percent: int, weights: np.ndarray) -> DataFrame:
    """(id, sig, n, minhash, prefix, bits); the last three stand with the first
    document of each set that a task sees."""
    kind = docs.schema["id"].dataType.simpleString()
    order = np.argsort(np.argsort(weights, kind="stable"), kind="stable").astype(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(order)
    mask = np.uint64((1 << BUCKET_BITS) - 1)

    def run(batches):
        order, seen = shared.value, set()
        for whole in batches:
            for b in sliced(whole):
                h, first = ngrams(b.column(1), n)
                sig, size, mins, prefixes, maps = [], [], [], [], []
                for i in range(b.num_rows):
                    s = set_of(h[first[i]:first[i + 1]])
                    size.append(len(s))
                    sig.append(signature(s))
                    if not len(s) or sig[-1] in seen:
                        mins.append(None)
                        prefixes.append(None)
                        maps.append(None)
                        continue
                    if len(seen) < 500_000:
                        seen.add(sig[-1])
                    key = order[(s & mask).astype(np.int64)] << np.uint64(64 - BUCKET_BITS) | s >> np.uint64(
                        BUCKET_BITS)
                    mins.append(_longs(_minhashes(s)))
                    maps.append(np.packbits(bits_of(s)).tobytes())
                    prefixes.append(_longs(s[np.argsort(key, kind="stable")[:prefix_size(len(s), percent)]]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(sig, pa.binary()), pa.array(size, pa.int64()),
                     pa.array(mins, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
                     pa.array(maps, pa.binary())], ["id", "sig", "n", "minhash", "prefix", "bits"])
    return docs.mapInArrow(freeing(run), f"id {kind}, sig binary, n long, minhash array<long>, prefix array<long>, "
                           "bits binary")


def _near_leaders(docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges (a, b) from nodes to a leader that they reach the threshold with."""
    keys = nodes.select(F.posexplode(F.slice("minhash", 1, SEEDS)).alias("seed", "mh"))
    both = keys.groupBy("seed", "mh").agg(F.count("*").alias("c")).where("c > 1")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(both.select(
        (F.col("mh").bitwiseXOR(F.col("seed").cast("long"))).alias("k")), "k"))

    def deal(batches):
        bits, seen = shared.value, set()
        for whole in batches:
            for b in sliced(whole):
                h, first = ngrams(b.column(0), n)
                at, seeds, mh, turn, sigs = [], [], [], [], []
                for i in range(b.num_rows):
                    s = set_of(h[first[i]:first[i + 1]])
                    if not len(s):
                        continue
                    m = _minhashes(s)[:SEEDS]
                    hits = np.flatnonzero(bits[bit_of(_longs(m) ^ np.arange(SEEDS))])
                    sig = signature(s) if len(hits) else None
                    if sig is None or sig in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(sig)
                    own = mix(np.frombuffer(sig, np.uint64)[:1], 50)
                    for k in hits.tolist():
                        at.append(i)
                        seeds.append(k)
                        mh.append(int(_longs(m)[k]))
                        turn.append(int(_longs(mix(own, k))[0]))
                        sigs.append(sig)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds, pa.int32()), pa.array(mh, pa.int64()), pa.array(turn, pa.int64()),
                     pa.array(sigs, pa.binary()), b.column(0).take(pa.array(at, pa.int64()))],
                    ["seed", "mh", "turn", "sig", "text"])

    def stars(batches):
        key, leaders, last = None, [], None
        for whole in batches:
            for b in sliced(whole):
                h, first = ngrams(b.column(4), n)
                a, z = [], []
                for i, (k, m, sig) in enumerate(zip(*(b.column(j).to_pylist() for j in (0, 1, 3)))):
                    if (k, m) != key:
                        key, leaders, last = (k, m), [], None
                    if sig == last:
                        continue
                    last, s = sig, set_of(h[first[i]:first[i + 1]])
                    lead = next((x for x, t in leaders if linked(s, t, percent)), None)
                    if lead is None:
                        leaders = [*leaders[-(LEADERS - 1):], (sig, s)]
                    elif lead != sig:
                        a.append(sig)
                        z.append(lead)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(z, pa.binary())], ["a", "b"])
    dealt = docs.select("text").mapInArrow(freeing(deal), "seed int, mh long, turn long, sig binary, text string")
    order = ["seed", "mh", "turn", "sig"]
    return (dealt.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
            .mapInArrow(stars, "a binary, b binary"))


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """(nid, g): queries and the groups whose union has a token of the
    query's prefix, where the group has other classes.

    For sets of n >= m tokens with ``a = ceil(t/(1+t) (n + m))`` the first
    common token is among the first n - a + 1 of the one and m - a + 1 of the
    other; the matrix holds the tokens that can be so for some n."""
    def least(n, m):
        return F.ceil((n + m) * percent / (100 + percent) - F.lit(1e-6))
    at, n = F.col("at"), F.col("n")
    post = nodes.select(F.posexplode("prefix").alias("at", "token"), "nid", "n")
    post = post.select("token", "nid", F.when(at <= n - least(n, n), at).alias("own"), at.cast("int").alias("at"))
    several = post.groupBy("token").agg(F.count("*").alias("c"), F.count("own").alias("own")).where(
        "c > 1 AND own > 0").select("token")
    post = post.join(several, "token").join(nodes.select("nid", "n", F.xxhash64("comp").alias("c"), "g"), "nid")
    post = stage_table(post, "postings")
    # the token-group matrix
    matrix = post.where("own IS NOT NULL").groupBy("token", "g").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("own").alias("own"), F.min("c").alias("c0"),
        F.max("c").alias("c1"))
    q = post.select("token", "nid", F.col("n").alias("qn"), F.col("c").alias("qc"), "at")
    lo = F.greatest(F.col("lo"), F.ceil(F.col("qn") * percent / 100 - F.lit(1e-6)))
    hi = F.least(F.col("hi"), F.col("qn"))
    met = q.join(matrix, "token").where(
        ((F.col("qc") != F.col("c0")) | (F.col("qc") != F.col("c1"))) & (lo <= hi)
        & (F.col("at") <= F.col("qn") - least(F.col("qn"), lo)) & (F.col("own") <= hi - least(F.col("qn"), hi)))
    return met.select("nid", "g").distinct()


def _met(nodes: DataFrame, cand: DataFrame) -> DataFrame:
    """(nid, g, n, bits, c, asks, asked): the nodes that are a candidate's query
    or may be so (``asks``), or that are of its group or may be (``asked``)."""
    broadcast = nodes.sparkSession.sparkContext.broadcast
    queries, groups = broadcast(np.packbits(bitmap(cand, "nid"))), broadcast(np.packbits(bitmap(cand, "g")))

    def hit(packed, column):
        at = bit_of(np.asarray(column))
        return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

    def mark(batches):
        for b in batches:
            asks, asked = hit(queries.value, b.column(0)), hit(groups.value, b.column(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(asks), pa.array(asked)],
                                             [*b.schema.names, "asks", "asked"]).filter(pa.array(asks | asked))
    return nodes.select("nid", "g", "n", "bits", F.xxhash64("comp").alias("c")).mapInArrow(
        freeing(mark), "nid long, g long, n long, bits binary, c long, asks boolean, asked boolean")


def _bounded(nodes: DataFrame, cand: DataFrame, percent: int) -> DataFrame:
    """The candidates whose overlap with the group's token union may reach
    the threshold: each bit of the query that the union lacks is a token that
    no member has."""
    cand = stage_table(cand, "candidates")
    nodes = stage_table(_met(nodes, cand), "met")

    def unite(batches):
        for b in batches:
            unions = []
            for maps in b.column(2).to_pylist():
                maps = [_unpack(x) for x in maps]
                size = min(map(len, maps))
                unions.append(np.packbits(np.any([fold(x, size) for x in maps], axis=0)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(unions, pa.binary())],
                                             ["g", "lo", "union"])

    def check(batches):
        for whole in batches:
            for b in sliced(whole):
                keep = []
                for n, q, lo, t in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5))):
                    q, t = _unpack(q), _unpack(t)
                    size = min(len(q), len(t))
                    miss = int((fold(q, size) & ~fold(t, size)).sum())
                    lo = max(lo, -(-percent * n // 100))
                    keep.append((n - miss) * (100 + percent) >= percent * (n + lo))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["nid", "g"]).filter(pa.array(keep))
    groups = nodes.where("asked").join(cand.select("g").distinct(), "g").groupBy("g").agg(
        F.min("n").alias("lo"), F.collect_list("bits").alias("maps")).mapInArrow(          # GROUP at most, or so
        unite, "g long, lo long, union binary")
    both = cand.join(nodes.where("asks").select("nid", "n", "bits"), "nid").join(groups, "g")
    left = both.select("nid", "g", "n", "bits", "lo", "union").mapInArrow(check, "nid long, g long")
    return _some_member(nodes, stage_table(left, "bounded"), percent)


def _reach(n: int, bits: np.ndarray, m: int, other: np.ndarray, percent: int) -> bool:
    """Whether sets with these sizes and bit maps may reach the threshold."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    size = min(len(bits), len(other))
    a, b = fold(bits, size), fold(other, size)
    same = min(n - int((a & ~b).sum()), m - int((b & ~a).sum()))
    return same * (100 + percent) >= percent * (n + m)


def _salted(cand: DataFrame) -> DataFrame:
    """(g, parts): into how many tasks the queries of a group are dealt."""
    return cand.groupBy("g").agg(F.count("*").alias("_n")).select(
        "g", F.ceil(F.col("_n") / (4 * GROUP)).cast("int").alias("parts"))


def _some_member(nodes: DataFrame, cand: DataFrame, percent: int) -> DataFrame:
    """The candidates of which the bit map of one member at least allows a
    link to the query."""
    per = _salted(cand)
    facts = nodes.where("asks").select("nid", "n", "bits", "c")
    q = cand.join(per, "g").withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts")).cast("int")).join(facts, "nid")
    m = nodes.where("asked").join(per, "g").select(
        F.col("g").alias("m_g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("m_part"),
        F.col("n").alias("m_n"), F.col("bits").alias("m_bits"), F.col("c").alias("m_c"))

    def test(key, q, m):
        members = [(n, _unpack(b), c) for n, b, c in zip(m["m_n"], m["m_bits"], m["m_c"])]
        keep = []
        for n, b, c in zip(q["n"], q["bits"], q["c"]):
            bits = _unpack(b)
            keep.append(any(c != d and _reach(n, bits, o, x, percent) for o, x, d in members))
        return q.loc[keep, ["nid", "g"]]
    return q.select("g", "part", "nid", "n", "bits", "c").groupBy("g", "part").cogroup(
        m.groupBy("m_g", "m_part")).applyInPandas(test, "nid long, g long")


def _open(docs: DataFrame, nodes: DataFrame, cand: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges (a, b) between classes, from comparing each query with the
    members of the groups it opens."""
    cand = stage_table(cand, "open")
    per = _salted(cand)
    members = nodes.join(per, "g").select("sig", "n", "comp", "doc", "g", "parts")
    queries = cand.join(per, "g").join(nodes.select("nid", "sig", "n", "comp", "doc"), "nid").withColumn(
        "part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    wanted = members.select("sig", "doc").union(queries.select("sig", "doc")).distinct()
    wanted = stage_table(wanted, "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64("doc").alias("k")), "k"))

    def pick(batches):
        for whole in batches:
            hit = bits.value[bit_of(np.asarray(whole.column(1)))]
            for b in sliced(whole.filter(pa.array(hit))):
                h, first = ngrams(b.column(0), n)
                s = [set_of(h[first[i]:first[i + 1]]) for i in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array([signature(x) for x in s], pa.binary()),
                                                  pa.array([x.tobytes() for x in s], pa.binary())], ["sig", "tokens"])
    sets = docs.select("text", F.xxhash64("id").alias("k")).mapInArrow(freeing(pick), "sig binary, tokens binary")
    sets = stage_table(sets.join(wanted.select("sig").distinct(), "sig").dropDuplicates(["sig"]), "sets")
    side = ["g", "part", "sig", "comp", "tokens"]
    left = queries.join(sets, "sig").select(*side)
    right = members.join(sets, "sig").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *[F.col(c).alias("m_" + c) for c in side])

    def compare(q, m):
        sets = [(c, np.frombuffer(t, np.uint64)) for c, t in zip(m["m_comp"], m["m_tokens"])]
        found = set()
        for comp, t in zip(q["comp"], q["tokens"]):
            s = np.frombuffer(t, np.uint64)
            for other, o in sets:
                if comp != other and (comp, other) not in found and linked(s, o, percent):
                    found.add((comp, other))
        return pd.DataFrame(sorted(found), columns=["a", "b"])
    return left.groupBy("g", "part").cogroup(right.groupBy("m_g", "m_part")).applyInPandas(compare, "a binary, b binary")


def _classes(docs: DataFrame, ngram: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (id, text): rows (id, sig, n), and for each set that has
    tokens (sig, doc, root): its smallest id and its component."""
    weights = token_weights(docs, ngram)
    sets = stage_table(_sets(docs.select("id", "text"), ngram, percent, weights), "sets")
    nodes = stage_table(sets.where("n > 0").groupBy("sig").agg(
        F.min("id").alias("doc"), F.max("n").alias("n"), F.first("minhash", True).alias("minhash"),
        F.first("prefix", True).alias("prefix"), F.first("bits", True).alias("bits")), "nodes")
    near = components(_near_leaders(docs, nodes, ngram, percent))
    keys = nodes.select("sig", F.col("minhash")[SEEDS].alias("mh"))       # groups are dealt without prefixes and bit maps
    parts = keys.groupBy("mh").agg(F.ceil(F.count("*") / GROUP).alias("_parts"))
    dealt = keys.join(parts, "mh").select("sig", F.xxhash64("mh", F.pmod(F.xxhash64("sig"), F.col("_parts"))).alias("g"))
    classed = nodes.drop("minhash").join(dealt, "sig").join(near.withColumnRenamed("node", "sig"), "sig", "left").withColumns(
        {"comp": F.coalesce("root", "sig"), "nid": F.xxhash64("sig")}).drop("root")
    classed = stage_table(classed, "classes")
    cand = _bounded(classed, _candidates(classed, percent), percent)
    links = _open(docs, classed.drop("prefix", "bits"), cand, ngram, percent)
    merged = components(links).select(F.col("node").alias("comp"), "root")
    return sets.select("id", "sig", "n"), classed.select("sig", "doc", "comp").join(
        merged, "comp", "left").withColumn("root", F.coalesce("root", "comp")).drop("comp")


def jaccard_components(docs: DataFrame, *, ngram: int = 3, percent: int = 90, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.  Two documents
    link when 100 * intersection >= percent * union of their n-gram sets; a
    component's id is its smallest doc_id."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sets, final = _classes(docs, ngram, percent)
    names = final.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = final.join(names, "root").select("sig", "component_id")
    return sets.join(named, "sig", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"))


def one_per_component(docs: DataFrame, *, ngram: int = 3, percent: int = 90, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``docs`` (same columns) with one row of each component, the one with
    the smallest id (rows without an id come last, equal ids by the hash of
    their texts); rows without words all stay."""
    key, words = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    row = F.struct(key.isNull().alias("last"), key.alias("id"), F.xxhash64(words).alias("text"))
    _, final = _classes(docs.select(row.alias("id"), words.alias("text")), ngram, percent)
    stay = final.groupBy("root").agg(F.min("doc").alias("doc")).select(
        F.xxhash64("doc.id").alias("_id"), F.col("doc.text").alias("_text"))
    some = F.coalesce(words.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.where(some).withColumns({"_id": F.xxhash64(key), "_text": F.xxhash64(words)}).join(
        stay, ["_id", "_text"]).dropDuplicates(["_id", "_text"])
    return docs.where(~some).unionAll(kept.select(*[F.col(f"`{c}`") for c in docs.columns]))
