"""The five benchmark queries on the columnar and the JSON-lines layout."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.operators import activity
from tidewright.operators.order_stats import median_and_tail
from tidewright.sources.tables import read_events, read_events_jsonl

TRIALS = 7


def bench_queries(as_of: int) -> dict[str, Callable[[DataFrame], DataFrame]]:
    return {
        "q1_top_repos": activity.top_counts,
        "q2_type_distribution": activity.type_distribution,
        "q3_recent_count": lambda ev: activity.recent_count(ev, 1, as_of),
        "q4_actor_activity": activity.actor_activity,
        "q5_push_stats": activity.payload_sum,
    }


def compare_formats(spark: SparkSession, parquet_path: str, jsonl_path: str, as_of: int) -> DataFrame:
    """Per query: rows of its answer and whether both layouts give the same rows."""
    stored, mirror = read_events(spark, parquet_path), read_events_jsonl(spark, jsonl_path)
    found = None
    for name, query in bench_queries(as_of).items():
        one, other = (
            rows.groupBy(F.struct(*rows.columns).alias("row")).count() for rows in (query(stored), query(mirror))
        )
        side = F.col("a.count").eqNullSafe(F.col("b.count"))
        both = one.alias("a").join(other.alias("b"), F.col("a.row").eqNullSafe(F.col("b.row")), "full")
        row = both.agg(
            F.coalesce(F.sum("a.count"), F.lit(0)).alias("n_rows"), F.coalesce(F.bool_and(side), F.lit(True)).alias("same")
        ).select(F.lit(name).alias("query"), "n_rows", "same")
        found = row if found is None else found.unionByName(row)
    return found


def run_once(rows: DataFrame) -> float:
    start = time.perf_counter()
    rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def time_formats(
    spark: SparkSession, parquet_path: str, jsonl_path: str, as_of: int, trials: int = TRIALS
) -> DataFrame:
    """Latency of every trial: query, format, seconds."""
    tables = {
        "parquet": read_events(spark, parquet_path),
        "jsonl": read_events_jsonl(spark, jsonl_path),
    }
    timings = [
        (name, fmt, run_once(query(table)))
        for name, query in bench_queries(as_of).items()
        for fmt, table in tables.items()
        for _ in range(trials)
    ]
    return spark.createDataFrame(timings, "query string, format string, seconds double")


def latency_summary(timings: DataFrame) -> DataFrame:
    """Median and tail per query and format with the speed-up of Parquet."""
    stats = median_and_tail(timings, ["query", "format"], "seconds")
    wide = stats.groupBy("query").agg(
        *[
            F.max(F.when(F.col("format") == fmt, F.col(stat))).alias(f"{fmt}_{stat}")
            for fmt in ("parquet", "jsonl")
            for stat in ("p50", "p99")
        ]
    )
    return wide.withColumn("speedup_p50", F.try_divide("jsonl_p50", "parquet_p50"))
