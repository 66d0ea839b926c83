"""Corpus pipeline: five stages over documents, each written and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duskwork.llm import decontamination, mixing, ngram_join, token_store, toxicity
from duskwork.llm.frames import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, learnt on the labelled ones among them."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each linked group."""
    return ngram_join.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come to their target weights."""
    return mixing.mixed(docs).select(*docs.columns)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of every document as read back from the written token shards."""
    return token_store.read_documents(token_store.write_shards(docs))


STAGES = [
    ("drop_toxic", drop_toxic), ("drop_near_copies", drop_near_copies), ("drop_benchmark", drop_benchmark),
    ("mix_sources", mix_sources), ("store_tokens", store_tokens),
]

# A trained score and a tokenizer take part, which SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
