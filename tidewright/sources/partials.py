"""Stored partial aggregates of ingested batches.

`activity/` (hourly counts), `lag/` and `newest/` (the newest events of each
batch) are partitioned by day and batch, so a look-back prunes by day and a
batch that runs again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.operators.hourly import hourly_counts, lag_sums
from tidewright.schemas import EVENT_TABLE_SCHEMA, LATE_PARTITION
from tidewright.sources.batches import partition_days, replace_batch, roll_up
from tidewright.sources.tables import read_batches

# Enough for a feed of that many rows from any set of batches.
NEWEST_ROWS = 20

ACTIVITY_SCHEMA = (
    "hour timestamp, event_type string, repo_name string, event_count bigint, last_seen_at timestamp, "
    "actors binary, day string"
)
# Files from when the sum was a bigint read as decimals too.
LAG_SCHEMA = "ingested_at timestamp, n bigint, lag_sum decimal(38,0), lag_min bigint, lag_max bigint, day string"


def write_partials(events: DataFrame, path: str, batch: str) -> None:
    """Partials of the new events of one batch (event columns and `date`)."""
    newest = events.orderBy(F.desc("created_at"), "event_id").limit(NEWEST_ROWS)
    replace_batch(hourly_counts(events), f"{path}/activity", batch, ["day"])
    replace_batch(lag_sums(events), f"{path}/lag", batch, ["day"])
    replace_batch(newest.withColumn("payload_json", F.lit(None).cast("string")), f"{path}/newest", batch, ["date"])


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/activity", ACTIVITY_SCHEMA)


def read_lag(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/lag", LAG_SCHEMA)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/newest", EVENT_TABLE_SCHEMA)


def newest_days(spark: SparkSession, path: str) -> list[str]:
    """Dates of the newest events in ascending order; the late one is left out."""
    return [day for day in partition_days(spark, f"{path}/newest", "date") if day != LATE_PARTITION]


def roll_up_partials(spark: SparkSession, path: str, unchanged_hours: float = 24) -> int:
    """Merge the partials of sealed batches; the number of batches."""
    merged = 0
    for name, schema, key in (
        ("activity", ACTIVITY_SCHEMA, "day"), ("lag", LAG_SCHEMA, "day"), ("newest", EVENT_TABLE_SCHEMA, "date")
    ):
        merged = max(merged, roll_up(spark, f"{path}/{name}", schema, [key], unchanged_hours))
    return merged
