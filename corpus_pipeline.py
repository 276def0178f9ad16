"""A training corpus from raw documents: language, near duplicates, benchmark hits, mix, token ids.

Every stage but the last returns the columns of its input; the last writes the
token files and returns what reading them gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import decontamination, language, mixing, near_duplicates, token_output
from tidewright.llm.common import ship, table
from tidewright.session import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    ship(spark)
    model = language.fit(docs, learn_from=language.learnable())
    return language.recognised(docs, model)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked from 0.8 of their shingles on."""
    ship(spark)
    return near_duplicates.without_near_duplicates(docs, percent=80)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending id order, and per document what they hold."""
    ship(spark)
    return token_output.encoded_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", free_of_benchmarks),
    ("mixing", mixed_sources),
    ("token_output", token_files),
]

# Hashing, sampling and tokenizing have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
