"""Hourly partial aggregates of events, and look-backs as sums over them.

A partial row counts the events of one hour, type and repository and carries a
HyperLogLog sketch of their actors. Partials of any batches add up, so a
look-back sums the full hours it covers and reads events only for the hour in
which it begins. Distinct actors come from the merged sketches (standard error
1.6 % at the default size; small sets are counted exactly); the exact count
needs the events and stays with `activity.top_entities`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.bands import lag_band
from tidewright.functions.time_bounds import MICROS_PER_HOUR, MICROS_PER_MINUTE, bound, date_key, lookback, micros_between
from tidewright.schemas import LATE_PARTITION

SKETCH_LG_K = 12


def hourly_counts(events: DataFrame) -> DataFrame:
    """day, hour, event_type, repo_name, event_count, last_seen_at, actors (sketch)."""
    hour = F.date_trunc("hour", F.col("created_at"))
    return (
        events.groupBy(hour.alias("hour"), "event_type", "repo_name")
        .agg(
            F.count("*").alias("event_count"),
            F.max("created_at").alias("last_seen_at"),
            F.hll_sketch_agg("actor_login", SKETCH_LG_K).alias("actors"),
        )
        .withColumn("day", date_key(F.col("hour")))
    )


def lag_sums(events: DataFrame) -> DataFrame:
    """Count, sum, least and largest lag of the events that came in at one instant.

    Microseconds of some million events that are days late outgrow a long, so the sum is a decimal.
    """
    lag = micros_between(F.col("created_at"), F.col("ingested_at"))
    return (
        events.where(F.col("ingested_at") >= F.col("created_at"))
        .groupBy("ingested_at")
        .agg(
            F.count("*").alias("n"),
            F.sum(lag.cast("decimal(20,0)")).cast("decimal(38,0)").alias("lag_sum"),
            F.min(lag).alias("lag_min"),
            F.max(lag).alias("lag_max"),
        )
        .withColumn("day", date_key(F.col("ingested_at")))
    )


def _day(micros: int) -> Column:
    return date_key(F.timestamp_micros(F.lit(micros)))


def counts_since(partials: DataFrame, events: DataFrame, as_of: int, minutes: float) -> DataFrame:
    """Partial rows that add up to the events at or after `as_of - minutes`.

    Of the events only the first, broken hour is read, by its date and late rows.
    """
    start = as_of - int(minutes * MICROS_PER_MINUTE)
    first_hour = -(-start // MICROS_PER_HOUR) * MICROS_PER_HOUR
    columns = ["hour", "event_type", "repo_name", "event_count", "last_seen_at", "actors"]
    full = partials.where(
        (F.col("day") >= _day(first_hour)) & (F.col("hour") >= F.timestamp_micros(F.lit(first_hour)))
    ).select(*columns)
    if first_hour == start:
        return full
    edge = lookback(events, "created_at", as_of, minutes).where(
        (F.col("created_at") < bound(events, "created_at", first_hour))
        & ((F.col("date") <= _day(first_hour)) | (F.col("date") == LATE_PARTITION))
    )
    return full.unionByName(hourly_counts(edge).select(*columns))


def event_counts(parts: DataFrame) -> DataFrame:
    """As `activity.event_counts`."""
    return (
        parts.groupBy("event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def top_entities(parts: DataFrame, limit: int = 10, entity: str = "repo_name") -> DataFrame:
    """As `activity.top_entities`, with distinct actors from merged sketches."""
    return (
        parts.groupBy(entity)
        .agg(
            F.sum("event_count").alias("event_count"),
            F.hll_sketch_estimate(F.hll_union_agg("actors")).alias("unique_actors"),
            F.max("last_seen_at").alias("last_seen_at"),
        )
        .orderBy(F.desc("event_count"), entity)
        .limit(limit)
    )


def lag_report(sums: DataFrame, as_of: int, minutes: float) -> DataFrame:
    """As `activity.lag_report`; a batch has one ingest time, so no hour is broken."""
    start = as_of - int(minutes * MICROS_PER_MINUTE)
    rows = sums.where((F.col("day") >= _day(start)) & (F.col("ingested_at") >= F.timestamp_micros(F.lit(start))))
    seconds = F.lit(1e6)
    stats = rows.agg(
        F.round(F.sum("lag_sum").cast("double") / F.sum("n") / seconds, 1).alias("avg_lag_seconds"),
        F.round(F.min("lag_min") / seconds, 1).alias("min_lag_seconds"),
        F.round(F.max("lag_max") / seconds, 1).alias("max_lag_seconds"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("sample_size"),
    ).where(F.col("avg_lag_seconds").isNotNull())
    return stats.withColumn("status", lag_band(F.col("avg_lag_seconds")))
