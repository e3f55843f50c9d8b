"""Registered queries of the operators: each applies one operator with its
production parameters to a whole table and derives the digest columns.

``QUERIES``: key -> (spark, sf_dir) -> DataFrame; ``SQL``: key -> DuckDB SQL.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_documents
from .common import shared_path, table
from . import doubling, fmindex
from .decontaminate import find_contamination
from .jaccard import jaccard_components
from .mixing import mix_plan
from .notices import BASE, find_notices
from .periodic import periodic_runs
from .pii import pseudonymise
from .template import extract
from .tokens import token_digest, write_tokens
from .vptree import nearest
from .toxicity import held_out, score, train, training_sample

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return deco


@query()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), ngram=3, percent=90)


@query(r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS s,
             row_number() OVER (ORDER BY source IS NULL, source) AS r FROM d GROUP BY source),
w AS (SELECT *, CAST((r - 1) % 3 + 1 AS DOUBLE) AS w FROM s),
l AS (SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER t, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER t, 0)) AS l
      FROM w WINDOW t AS (ORDER BY s / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, s, w, least(max(l) OVER () * w, CAST(3 * s AS DOUBLE)) AS target,   -- weights at the start, twice slopes
             CASE (r - 1) % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 3.0 ELSE 2.0 END AS w0,
             CASE (r - 1) % 3 WHEN 0 THEN 0.0 WHEN 1 THEN -4.0 ELSE 4.0 END AS slope FROM l),
c AS (SELECT d.*, s, w, w0, slope, target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS start,
             CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS p
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
, n AS (SELECT *, p + CASE WHEN 2 * start + size < 2 * (target - p * s) THEN 1 ELSE 0 END AS copies FROM c),
k AS (SELECT *, w * least(CAST(start AS DOUBLE) / target, 1.0) AS first_need,
             w * least(CAST((copies - 1) * s + start AS DOUBLE) / target, 1.0) AS last_need FROM n)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target, CAST(copies * size AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN 2 * first_need / (w0 + sqrt(w0 * w0 + slope * first_need)) END AS first_at,
       CASE WHEN copies > 0 THEN 2 * last_need / (w0 + sqrt(w0 * w0 + slope * last_need)) END AS last_at
FROM k""")
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the training positions of each document's first and last copy."""
    return mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("first_at"),
        F.get("positions", (F.col("copies") - 1).cast("int")).alias("last_at"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query()
def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_tokens(table(spark, sf_dir, "documents"), shared_path(spark, "tokens"), tokenizer=vocabulary())
    return token_digest(spark, path)


def toxicity_weights(docs: DataFrame, spark: SparkSession, sf_dir: str):
    """Weights fitted on at most about 20,000 labelled rows that are not held out."""
    return train(training_sample(docs, table(spark, sf_dir, "labels"), label="toxic", sample_rows=20_000,
                                 usable=~held_out(F.col("key"))))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, toxicity_weights(docs, spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL
                 OR NOT isfinite(x)), true) AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, factor=1.0)


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a parameter; a deployment passes its own secret."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="public-demonstration-key")


@query()
def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.remove_repeats(table(spark, sf_dir, "documents"), window=13).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op10_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.remove_repeats(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query()
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query()
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                           vocabulary("piece_bpe_32k.model"))


def with_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by crc32 of the id, repeat a part of their
    words from some word to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.slice(words, a + 1, p)                        # the words that repeat
    repeated = F.flatten(F.array_repeat(tail, F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), changed)
                       .otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")), exponent=4, least=6)
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest["start"].alias("start"),
                        (-longest["less"]).alias("length"), longest["period"].alias("period"),
                        F.floor(1000 * -longest["less"] / longest["period"]).alias("exponent_milli"),
                        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256)
                        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query()
def op11_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_notices(table(spark, sf_dir, "documents"), chars_per_edit=7)
    base = F.filter("places", lambda p: (p["edits"] == 0) & p["notice"].isin([phrase for _, phrase in BASE]))

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))
