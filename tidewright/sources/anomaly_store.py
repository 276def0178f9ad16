"""Append-only anomaly store keyed by `anomaly_id`; the first entry wins."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.operators.dedupe import first_per_key, not_stored
from tidewright.schemas import ANOMALY_SCHEMA
from tidewright.session import written
from tidewright.sources.sinks import overwrite
from tidewright.sources.tables import read_anomalies

_COLUMNS = [f.name for f in ANOMALY_SCHEMA.fields]


def to_rows(anomalies: DataFrame) -> DataFrame:
    """Metric map to JSON text."""
    return anomalies.withColumn(
        "metric_json", F.to_json("metric", {"ignoreNullFields": "false"})
    ).select(*_COLUMNS)


def from_rows(rows: DataFrame) -> DataFrame:
    """JSON text back to a metric map; no text gives an empty map."""
    return rows.withColumn(
        "metric",
        F.from_json(F.coalesce("metric_json", F.lit("{}")), "map<string,double>"),
    ).drop("metric_json")


def fresh_rows(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows whose id is not in the store, one per id."""
    unique = first_per_key(new, "anomaly_id", "detected_at", "title")
    return not_stored(unique, existing, "anomaly_id")


def newest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("detected_at"), "anomaly_id")


def load(spark: SparkSession, path: str) -> DataFrame:
    """Stored anomalies, newest first, metric decoded.

    Two detectors that append the same id at once leave two rows; the earlier
    one counts.
    """
    rows = first_per_key(read_anomalies(spark, path), "anomaly_id", "detected_at")
    return newest_first(from_rows(rows))


def save(spark: SparkSession, anomalies: DataFrame, path: str) -> None:
    """Add anomalies that are not stored yet. Stored rows are never rewritten."""
    fresh = fresh_rows(to_rows(anomalies), read_anomalies(spark, path)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A silent sweep leaves no file behind.
        if not fresh.isEmpty():
            fresh.coalesce(1).write.mode("append").parquet(path)
    finally:
        fresh.unpersist()


def compact(spark: SparkSession, path: str) -> None:
    """One file for all stored anomalies; run it while no detector writes."""
    overwrite(written(read_anomalies(spark, path), "anomalies").coalesce(1), path)


def by_id(rows: DataFrame, anomaly_id: str) -> DataFrame:
    return rows.where(F.col("anomaly_id") == anomaly_id)
