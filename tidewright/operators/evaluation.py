"""Retrieval quality: evaluation set, ranks, recall@k and mean reciprocal rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.functions.text import strip_whitespace
from tidewright.operators.neighbors import nearest
from tidewright.operators.ranking import seeded_sample

# Fixed value: shorter titles say too little to be a query.
MIN_TITLE_CHARS = 15


def eval_set(cases: DataFrame, n: int | None = 50, seed: int = 42) -> DataFrame:
    """Titles as queries, their own case as the expected answer."""
    query = strip_whitespace(F.col("title"))
    usable = cases.select(query.alias("query"), F.col("case_id").alias("expected_case_id")).where(
        F.length("query") >= MIN_TITLE_CHARS
    )
    return usable if n is None else seeded_sample(usable, "expected_case_id", n, seed)


def expected_ranks(pairs: DataFrame, results: DataFrame) -> DataFrame:
    """Rank of the expected case per query; NULL when it was not found."""
    hits = results.select("query_id", F.col("case_id").alias("expected_case_id"), "rank")
    return pairs.join(hits, ["query_id", "expected_case_id"], "left")


def summary(ranks: DataFrame, k_values: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """recall@k and MRR rounded to four places; an empty set gives zeros."""

    def mean(value):
        return F.bround(F.coalesce(F.avg(value), F.lit(0.0)), 4)

    rank = F.col("rank")
    return ranks.agg(
        F.count("*").alias("n"),
        *[
            mean(F.when(rank <= k, F.lit(1.0)).otherwise(F.lit(0.0))).alias(f"recall_at_{k}")
            for k in k_values
        ],
        mean(F.coalesce(F.lit(1.0) / rank, F.lit(0.0))).alias("mrr"),
    )


def evaluate(
    pairs: DataFrame,
    corpus: DataFrame,
    k_values: tuple[int, ...] = (1, 3, 5),
    search_top_k: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Summary and per-query ranks for (query_id, embedding, expected_case_id)."""
    depth = max(search_top_k, max(k_values, default=0))
    ranks = expected_ranks(pairs.drop("embedding"), nearest(pairs, corpus, depth))
    return summary(ranks, k_values), ranks
