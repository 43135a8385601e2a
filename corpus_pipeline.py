"""Corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir), works on all rows it gets and, but for the last, returns the columns of documents.
Null and empty texts pass the filters (they are neither toxic nor copies nor contaminated); the mix never takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnspark.llm import bayes_join, decontaminate, mixing, substrings, toxicity
from churnspark.llm.tables import table, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from the labels (two folds of three) predicts toxic go."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.filtered(docs, labels.filter(toxicity.fold() != 1))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, the one with the smallest id."""
    return bayes_join.filtered(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that occur earlier are cut; a document of which nothing is left goes."""
    return substrings.filtered(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark windows go."""
    return decontaminate.filtered(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``, how often."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", clean), ("n-gram Jaccard join", distinct), ("substring dedup", without_repeats),
    ("benchmark decontamination", uncontaminated), ("mixing sources to target weights", mixed),
]

# Learned scores and MinHash pruning have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
