"""Corpus pipeline: toxicity filter, near-duplicate join, passage dedup, source
mixing and sampled SentencePiece encoding, each stage over all documents that
its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacelake.llm import jaccard, mixing, pieces, substring, toxicity
from pacelake.llm.common import documents, ship, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not reject. It learns from the
    labelled documents among ``docs`` that are not held out."""
    ship(spark)
    return toxicity.without_toxic(docs, toxicity.trained(spark, docs, sf_dir))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    ship(spark)
    return jaccard.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages of 50 words and more that an earlier
    document has; a document of which nothing is left goes."""
    ship(spark)
    return substring.without_passages(docs, substring.repeated_passages(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced mix of sources takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document that is left."""
    ship(spark)
    return pieces.sampled(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: No stage is expressible in plain SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents of a folder, each written as Parquet and
    read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
