"""Table schemas, fixed thresholds and sentinels."""

from __future__ import annotations

from pyspark.sql import types as T

# Partition sentinel and late threshold.
LATE_PARTITION = "late"
LATE_THRESHOLD_HOURS = 24

EVENT_COLUMNS = [
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "payload_json",
    "public",
    "created_at",
    "ingested_at",
]

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("actor_id", T.LongType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("repo_id", T.LongType()),
        T.StructField("repo_name", T.StringType(), False),
        T.StructField("payload_json", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)

# `date` stays a string because of the `late` sentinel; inference would call
# it DATE until the first late row arrives.
EVENT_TABLE_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField("date", T.StringType())]
)

DLQ_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("error_reason", T.StringType(), False),
        T.StructField("raw_json", T.StringType(), False),
        T.StructField("failed_at", T.TimestampType(), False),
    ]
)

CI_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("repo", T.StringType(), False),
        T.StructField("workflow_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("conclusion", T.StringType()),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

ANOMALY_SCHEMA = T.StructType(
    [
        T.StructField("anomaly_id", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("metric_json", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("detected_at", T.TimestampType(), False),
        T.StructField("is_demo", T.BooleanType(), False),
    ]
)

CASE_SCHEMA = T.StructType(
    [
        T.StructField("case_id", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("number", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("body_snippet", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("closed_at", T.TimestampType()),
        T.StructField("time_to_resolve_hours", T.DoubleType()),
        T.StructField("is_revert", T.BooleanType(), False),
        T.StructField("reverts_number", T.LongType()),
        T.StructField("was_reverted", T.BooleanType(), False),
        T.StructField("reverted_by", T.LongType()),
    ]
)

EMBEDDING_SCHEMA = T.StructType(
    [
        T.StructField("case_id", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    ]
)
