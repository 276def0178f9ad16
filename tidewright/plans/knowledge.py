"""Knowledge-base build and diagnosis records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.functions.bands import evidence_strength
from tidewright.functions.text import joined_subject
from tidewright.operators import cases as C
from tidewright.operators import neighbors, outcomes
from tidewright.sources.sinks import overwrite
from tidewright.sources.tables import read_cases, read_embeddings


def build_knowledge_base(
    items: DataFrame, position: str, cases_path: str, embeddings_path: str, embed
) -> None:
    """Items to the case table, then its texts to the embedding table.

    The embedding job reads the written cases, so the two tables agree.
    """
    spark = items.sparkSession
    overwrite(C.build_cases(items, position), cases_path)
    overwrite(C.embed_cases(read_cases(spark, cases_path), embed), embeddings_path)


def load_corpus(spark: SparkSession, cases_path: str, embeddings_path: str) -> DataFrame:
    """Cases with vectors; empty while one of the tables is missing."""
    return C.searchable(read_cases(spark, cases_path), read_embeddings(spark, embeddings_path))


def anomaly_subjects(anomalies: DataFrame, embed) -> DataFrame:
    """Anomalies as subjects: id, text, vector."""
    subject = joined_subject(F.col("title"), F.col("description"))
    rows = anomalies.select(F.col("anomaly_id").alias("query_id"), subject.alias("subject"))
    return embed(rows, "subject")


def diagnose(
    subjects: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    live: Column | None = None,
) -> DataFrame:
    """Similar cases, outcome estimate and evidence for every subject.

    `subjects` has query_id, subject and embedding; `live` may be an
    expression over its columns or a literal text.
    """
    live_text = F.lit(None).cast("string") if live is None else live
    base = subjects.select("query_id", "subject", live_text.alias("live"))
    found = neighbors.search(subjects, corpus, k)
    matches = found.select("query_id", "case_id")
    estimate = outcomes.estimate_outcomes(base, matches, corpus)
    blocks = F.coalesce("blocks", F.array().cast("array<string>"))
    return (
        base.join(outcomes.evidence_blocks(found), "query_id", "left")
        .join(outcomes.trimmed_cases(found), "query_id", "left")
        .join(estimate, "query_id", "left")
        .select(
            "query_id",
            "subject",
            "sample_size",
            evidence_strength(F.col("sample_size")).alias("evidence"),
            "pr_count",
            "revert_rate",
            "avg_time_to_resolve_hours",
            "severity_labels",
            "similar_cases",
            outcomes.with_live_block(blocks, F.col("live")).alias("raw_evidence"),
            outcomes.context_text(F.col("subject"), blocks, F.col("live")).alias("context"),
        )
    )
