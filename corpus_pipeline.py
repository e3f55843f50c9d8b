"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination,
mixing and tokenised output, each stage a Parquet table for the next one."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, jaccard, mixing, tokens, toxicity
from tessera.llm.common import shared_path, stage_table, table
from tessera.llm.queries import toxicity_weights, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    weights = toxicity_weights(docs.select("doc_id", "text"), spark, sf_dir)
    return toxicity.score(docs, weights, column="_toxicity").where("_toxicity < 0.7").drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents whose five-word shingles are similar by
    0.8 or more, the one with the smallest id stays."""
    return jaccard.one_per_component(docs, ngram=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 10 benchmark words are cut out; a document that is more than
    half benchmark goes."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5,
                                              n_chars="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mix takes, in training order."""
    return mixing.mix_documents(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each row's ids, from the written files."""
    path = tokens.write_tokens(docs, shared_path(spark, "tokens"), tokenizer=vocabulary())
    return tokens.token_digest(spark, path)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", remove_benchmark),
          ("mixing", mix_sources), ("tokens", write_ids)]
ORACLE_SQL = None       # scores, similarity joins and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage_table(docs, name)
    return docs
