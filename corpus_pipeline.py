"""Corpus pipeline: every stage calls one operator of ``strata.llm`` on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, huffman, minhash, mixing, quality
from strata.llm.common import stage, table
from strata.llm.queries import word_vocabulary

NEAR = 80  # percent of the word shingles; op9's 85 belongs to its own contract


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: rejected documents go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: the smallest id of each group stays."""
    return minhash.first_of_each(docs, threshold=NEAR)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with any hit go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents are sampled by calibrated probabilities."""
    return mixing.sampled_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id output: what the written files hold, per document."""
    return huffman.digest(huffman.write_and_read(docs, word_vocabulary()))


STAGES = [
    ("quality classifier", good),
    ("near-dedup", distinct),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token output", encoded),
]
# Fitted models, MinHash and tokenisation are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
