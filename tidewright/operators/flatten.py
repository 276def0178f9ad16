"""Raw event JSON to parsed fields, flat columns and partition keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions import json_text as J
from tidewright.functions.binding import evaluated_once
from tidewright.functions.time_bounds import date_key
from tidewright.schemas import EVENT_COLUMNS, LATE_PARTITION, LATE_THRESHOLD_HOURS

# The keys read from an event, its actor and its repository.
EVENT_KEYS = ["id", "type", "actor", "repo", "payload", "public", "created_at"]
ACTOR_KEYS = ["id", "login"]
REPO_KEYS = ["id", "name"]


def parse_raw(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add `ev`, `actor` and `repo` as structs of texts.

    `ev` is NULL for text that is not one JSON object.
    """
    parsed = evaluated_once(raw, {"ev": J.strict_fields(F.col(value), EVENT_KEYS)})
    return evaluated_once(
        parsed,
        {
            "actor": J.as_fields(F.col("ev.actor"), ACTOR_KEYS),
            "repo": J.as_fields(F.col("ev.repo"), REPO_KEYS),
            "created_at_text": J.iso_timestamp(F.col("ev.created_at")),
        },
    )


def repo_object() -> J.JsonObject:
    return J.JsonObject(F.col("repo"), F.col("ev.repo"))


def flatten(parsed: DataFrame, ingested_at: Column) -> DataFrame:
    """Project the flat event columns next to whatever else is there.

    `ingested_at` is one stamp for the batch. An unusable `created_at`
    becomes the ingest stamp, and `created_at_ok` tells which rows those are.
    """
    payload, public = F.col("ev.payload"), F.col("ev.public")
    created = F.col("created_at_text")
    return parsed.withColumns(
        {
            "event_id": F.coalesce("ev.id", F.lit("")),
            "event_type": F.coalesce("ev.type", F.lit("")),
            "actor_id": F.col("actor.id").try_cast("bigint"),
            "actor_login": F.col("actor.login"),
            "repo_id": F.col("repo.id").try_cast("bigint"),
            "repo_name": repo_object().get_or("name", F.lit("")),
            "payload_json": F.when(J.truthy(payload), payload),
            "public": F.when(public.isNotNull(), J.truthy(public)),
            "created_at_ok": created.isNotNull(),
            "created_at": F.coalesce(created, ingested_at),
            "ingested_at": ingested_at,
        }
    ).drop("ev", "actor", "repo", "created_at_text")


def partition_key(threshold_hours: float = LATE_THRESHOLD_HOURS) -> Column:
    """`late` when strictly older than the threshold, else the event date."""
    age = F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("ingested_at"))
    limit = F.lit(int(threshold_hours * 3_600_000_000))
    return F.when(age > limit, F.lit(LATE_PARTITION)).otherwise(date_key(F.col("created_at")))


def with_partition(
    events: DataFrame, threshold_hours: float = LATE_THRESHOLD_HOURS
) -> DataFrame:
    return events.withColumn("date", partition_key(threshold_hours))


def event_columns(events: DataFrame, *extra: str) -> DataFrame:
    return events.select(*EVENT_COLUMNS, *extra)


def as_json_line(events: DataFrame) -> DataFrame:
    """One JSON text per row with ISO-8601 UTC timestamps and null fields kept."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
    return events.select(F.to_json(F.struct(*events.columns), options).alias("value"))
