"""Keeping look-back metrics and the anomaly store current as events land."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewright.functions.time_bounds import now_micros, to_micros
from tidewright.operators import activity, detection, hourly, ranking
from tidewright.plans.feed import newest_by_day, recent_feed
from tidewright.schemas import EVENT_TABLE_SCHEMA
from tidewright.sources import anomaly_store, partials
from tidewright.sources.sinks import swap_in
from tidewright.sources.tables import late_hours as read_late_hours, read_ci_runs, read_events

# Seconds between two refreshes and two detection sweeps.
REFRESH_SECONDS = 4
SWEEP_SECONDS = 5


def metric_tables(
    spark: SparkSession,
    events_path: str,
    as_of: int,
    since_minutes: float = 60,
    limit: int = 10,
    late_hours: float | None = None,
    partials_path: str | None = None,
) -> dict[str, DataFrame]:
    """Every table reads only the dates it needs; the lag does so by the late threshold, given or noted with the table.

    With the partials of the ingest, events are read for the broken first hour
    alone, and distinct actors are estimated.
    """
    events = read_events(spark, events_path)
    if partials_path:
        parts = hourly.counts_since(partials.read_activity(spark, partials_path), events, as_of, since_minutes)
        return {
            "event_counts": ranking.share_of_total(hourly.event_counts(parts), "event_count"),
            "top_entities": hourly.top_entities(parts, limit),
            "lag": hourly.lag_report(partials.read_lag(spark, partials_path), as_of, since_minutes),
            "recent": newest_by_day(
                partials.read_newest(spark, partials_path), partials.newest_days(spark, partials_path)
            ),
        }
    late_hours = read_late_hours(spark, events_path) if late_hours is None else late_hours
    counts = activity.event_counts(events, since_minutes, as_of)
    return {
        "event_counts": ranking.share_of_total(counts, "event_count"),
        "top_entities": activity.top_entities(events, since_minutes, limit, as_of),
        "lag": activity.lag_report(events, since_minutes, as_of, late_hours),
        "recent": recent_feed(spark, events_path),
    }


def refresh_metrics(
    spark: SparkSession,
    events_path: str,
    out_path: str,
    as_of: datetime | int | None = None,
    since_minutes: float = 60,
    late_hours: float | None = None,
    partials_path: str | None = None,
) -> None:
    """Renew every look-back table; each is a small aggregate.

    A result is written beside the old one and takes its place when complete.
    """
    at = now_micros() if as_of is None else to_micros(as_of)
    found = metric_tables(spark, events_path, at, since_minutes, late_hours=late_hours, partials_path=partials_path)
    for name, rows in found.items():
        swap_in(rows, f"{out_path}/{name}")


def sweep(
    spark: SparkSession,
    events_path: str,
    runs_path: str,
    anomaly_path: str,
    as_of: datetime | int | None = None,
    repo: str | None = None,
) -> None:
    """Run all rules and add what is new to the store."""
    at = now_micros() if as_of is None else to_micros(as_of)
    found = detection.detect_all(
        read_events(spark, events_path), read_ci_runs(spark, runs_path), at, repo
    )
    anomaly_store.save(spark, found, anomaly_path)


def _arrivals(spark: SparkSession, events_path: str) -> DataFrame:
    return spark.readStream.schema(EVENT_TABLE_SCHEMA).parquet(events_path)


def _start(stream: DataFrame, action, checkpoint: str, seconds: int | None) -> StreamingQuery:
    # The rows only signal that something landed; the work reads the table.
    writer = (
        stream.select("date")
        .writeStream.foreachBatch(lambda _rows, _id: action())
        .option("checkpointLocation", checkpoint)
    )
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def start_refresh(
    spark: SparkSession,
    events_path: str,
    out_path: str,
    checkpoint: str,
    as_of: datetime | int | None = None,
    since_minutes: float = 60,
    seconds: int | None = REFRESH_SECONDS,
    late_hours: float | None = None,
    partials_path: str | None = None,
) -> StreamingQuery:
    """Refresh the metric tables whenever new event files landed."""
    return _start(
        _arrivals(spark, events_path),
        lambda: refresh_metrics(spark, events_path, out_path, as_of, since_minutes, late_hours, partials_path),
        checkpoint,
        seconds,
    )


def start_sweeps(
    spark: SparkSession,
    events_path: str,
    runs_path: str,
    anomaly_path: str,
    checkpoint: str,
    as_of: datetime | int | None = None,
    seconds: int | None = SWEEP_SECONDS,
) -> StreamingQuery:
    """Sweep for anomalies at most once per interval while events arrive."""
    return _start(
        _arrivals(spark, events_path),
        lambda: sweep(spark, events_path, runs_path, anomaly_path, as_of),
        checkpoint,
        seconds,
    )
