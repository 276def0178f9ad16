"""Newest events of a stored table without reading its history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.functions.time_bounds import lookback
from tidewright.operators.activity import recent_events
from tidewright.sources.tables import event_days, read_events


def recent_feed(
    spark: SparkSession, path: str, limit: int = 20, event_type: str | None = None
) -> DataFrame:
    """Same rows as `recent_events` over the whole table."""
    return newest_by_day(read_events(spark, path), event_days(spark, path), limit, event_type)


def newest_by_day(
    events: DataFrame, days: list[str], limit: int = 20, event_type: str | None = None
) -> DataFrame:
    """Same rows as `recent_events` over all of `events`, partitioned by `date`.

    `days` are their dates in ascending order, the late one left out. They are
    probed from the newest backwards, twice as many each time, until they hold
    enough rows. The oldest of those rows bounds the answer, late rows included,
    so the final scan is pruned to it.
    """
    dated = days[::-1]
    wanted = events if event_type is None else events.where(F.col("event_type") == event_type)
    taken = 1
    while taken <= len(dated):
        probe = (
            wanted.where(F.col("date").isin(dated[:taken]))
            .select("created_at")
            .orderBy(F.desc("created_at"))
            .limit(limit)
        )
        found = probe.agg(
            F.count("*").alias("n"), F.unix_micros(F.min("created_at")).alias("oldest")
        ).first()
        if found["n"] == limit:
            return recent_events(lookback(events, "created_at", found["oldest"], 0), limit, event_type)
        taken *= 2
    return recent_events(events, limit, event_type)
