"""Cleaning a training corpus: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from textloom.llm.common import small_batches, stored
from textloom.llm.queries import table, toxicity_model


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.accepted(docs, toxicity_model(spark, sf_dir, docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    small_batches(spark)
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words that occur more than once are cut out; every document stays."""
    small_batches(spark)
    return suffix_dedup.trimmed(docs, length=51, gram=25, words=True)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences: a row for each piece of every document."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("ngram_jaccard_join", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", packed),
]

# The classifier and the packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
