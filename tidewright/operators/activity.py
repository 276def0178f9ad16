"""Look-back counts, top entities, feed, lag and freshness over events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidewright.functions.bands import lag_band
from tidewright.functions.binding import evaluated_once
from tidewright.functions.time_bounds import lookback, resolve_as_of, seconds_between

When = datetime | int | None


def event_counts(events: DataFrame, since_minutes: float = 60, as_of: When = None) -> DataFrame:
    """Events per type in the look-back, largest first."""
    at = resolve_as_of(events, "created_at", as_of)
    return (
        lookback(events, "created_at", at, since_minutes)
        .groupBy("event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def top_entities(
    events: DataFrame,
    since_minutes: float = 60,
    limit: int = 10,
    as_of: When = None,
    entity: str = "repo_name",
    approximate: bool = False,
) -> DataFrame:
    """Most active entities with distinct actors and last activity.

    The exact distinct count first shuffles on (entity, actor), which spreads
    a dominating entity over all tasks.
    """
    at = resolve_as_of(events, "created_at", as_of)
    actors = F.approx_count_distinct if approximate else F.countDistinct
    return (
        lookback(events, "created_at", at, since_minutes)
        .groupBy(entity)
        .agg(
            F.count("*").alias("event_count"),
            actors("actor_login").alias("unique_actors"),
            F.max("created_at").alias("last_seen_at"),
        )
        .orderBy(F.desc("event_count"), entity)
        .limit(limit)
    )


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("n"))


def latest_event(events: DataFrame, ts: str = "created_at") -> DataFrame:
    return events.agg(F.max(ts).alias("latest"))


def lag_stats(
    events: DataFrame, since_minutes: float = 60, as_of: When = None, late_hours: float | None = None
) -> DataFrame:
    """Ingest lag in seconds; one row, NULL statistics when nothing matches.

    With `late_hours`, the late threshold of the table, old dates are not read.
    """
    at = resolve_as_of(events, "ingested_at", as_of)
    lag = seconds_between(F.col("created_at"), F.col("ingested_at"))
    return (
        lookback(events, "ingested_at", at, since_minutes, late_hours)
        .where(F.col("ingested_at") >= F.col("created_at"))
        .select(lag.alias("lag"))
        .agg(
            F.round(F.avg("lag"), 1).alias("avg_lag_seconds"),
            F.round(F.min("lag"), 1).alias("min_lag_seconds"),
            F.round(F.max("lag"), 1).alias("max_lag_seconds"),
            F.count("*").alias("sample_size"),
        )
    )


def lag_report(
    events: DataFrame, since_minutes: float = 60, as_of: When = None, late_hours: float | None = None
) -> DataFrame:
    """Lag statistics with their band; no row when there is no data."""
    stats = lag_stats(events, since_minutes, as_of, late_hours).where(F.col("avg_lag_seconds").isNotNull())
    return stats.withColumn("status", lag_band(F.col("avg_lag_seconds")))


def recent_events(events: DataFrame, limit: int = 20, event_type: str | None = None) -> DataFrame:
    """Newest events. A type filter applies before the limit, so it never
    returns fewer rows than exist."""
    rows = events if event_type is None else events.where(F.col("event_type") == event_type)
    return (
        rows.orderBy(F.desc("created_at"), "event_id")
        .limit(limit)
        .select("event_type", "actor_login", "repo_name", "created_at")
    )


def top_counts(events: DataFrame, entity: str = "repo_name", limit: int = 10) -> DataFrame:
    return (
        events.groupBy(entity)
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), entity)
        .limit(limit)
    )


def type_distribution(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "event_type")
    )


def recent_count(events: DataFrame, hours: float = 1, as_of: When = None) -> DataFrame:
    at = resolve_as_of(events, "created_at", as_of)
    return lookback(events, "created_at", at, hours * 60).agg(
        F.count("*").alias("recent_count")
    )


def actor_activity(events: DataFrame, limit: int = 20) -> DataFrame:
    return (
        events.groupBy("actor_login")
        .agg(F.count("*").alias("events"), F.countDistinct("event_type").alias("types"))
        .orderBy(F.desc("events"), "actor_login")
        .limit(limit)
    )


def payload_sum(
    events: DataFrame, event_type: str = "PushEvent", path: str = "$.size"
) -> DataFrame:
    """Count and integer sum of a payload field over the events that have it."""
    having = events.where((F.col("event_type") == event_type) & F.col("payload_json").isNotNull())
    size = evaluated_once(having, {"size": F.get_json_object("payload_json", path)})
    return (
        size.where(F.col("size").isNotNull())
        .agg(
            F.count("*").alias("total_push_events"),
            F.sum(F.col("size").try_cast("int")).alias("total_commits"),
        )
    )
