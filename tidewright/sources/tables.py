"""Table readers. A missing or empty source gives an empty table, never an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewright.schemas import (
    ANOMALY_SCHEMA,
    CASE_SCHEMA,
    CI_RUN_SCHEMA,
    DLQ_SCHEMA,
    EMBEDDING_SCHEMA,
    EVENT_TABLE_SCHEMA,
    LATE_PARTITION,
)
from tidewright.sources import manifest
from tidewright.sources.files import folder_names, has_data, make_folder, partition_names

# Folder of the event table whose sub-folders are named for what holds for all its rows.
SETTINGS = "_settings"
# Partition column of tables that keep one partition per ingest batch.
BATCH = "ingest_batch"
# Folder of the event table in which compactions write their runs.
COMPACTED = "_compacted"


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """Read with a declared schema.

    Columns that older files lack come back as NULL, so a table can gain
    nullable columns without rewriting its files.
    """
    suffix = {"parquet": ".parquet", "json": ".json"}[fmt]
    if not has_data(spark, path, suffix):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def with_batch(schema: T.StructType | str) -> T.StructType:
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([f for f in fields if f.name != BATCH] + [T.StructField(BATCH, T.StringType())])


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All batches, rolled up or not, each once; columns of the schema, then the batch."""
    whole = with_batch(schema)
    base = read_or_empty(spark, path, whole)
    known = manifest.state(spark, path)
    if not known.runs:
        return base
    if known.drops:
        base = base.where(~F.col(BATCH).isin(*known.drops))
    rolled = spark.read.schema(T.StructType([*whole.fields, T.StructField("run", T.StringType())])).parquet(f"{path}/_rolled")
    return base.unionByName(rolled.where(F.col("run").isin(*known.runs)).select(*whole.names))


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of `read_events` with the name of the file each stands in.

    A task gives its files the same name in every date, so the date belongs to it.
    """
    known = manifest.state(spark, path)
    file_name = F.concat(F.lit("date="), "date", F.lit("/"), F.col("_metadata.file_name"))
    named = [*EVENT_TABLE_SCHEMA.names, file_name.alias("file_name")]
    rows = spark.createDataFrame([], T.StructType([*EVENT_TABLE_SCHEMA.fields, T.StructField("file_name", T.StringType())]))
    if has_data(spark, path):
        rows = spark.read.schema(EVENT_TABLE_SCHEMA).parquet(path).select(*named)
    if known.runs:
        runs = T.StructType([*EVENT_TABLE_SCHEMA.fields, T.StructField("run", T.StringType())])
        merged = spark.read.schema(runs).parquet(f"{path}/{COMPACTED}").where(F.col("run").isin(*known.runs))
        rows = rows.unionByName(merged.select(*named))
    if known.drops:
        # The files of one compaction at most; once they are deleted the list is empty.
        dropped = F.broadcast(spark.createDataFrame([(x,) for x in known.drops], "file_name string"))
        rows = rows.join(dropped, "file_name", "left_anti")
    return rows


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All date partitions, the late one included; every row once, whatever a compaction is doing."""
    if not manifest.state(spark, path).runs:
        return read_or_empty(spark, path, EVENT_TABLE_SCHEMA)
    return read_event_files(spark, path).select(*EVENT_TABLE_SCHEMA.names)


def late_hours(spark: SparkSession, path: str) -> float | None:
    """The late threshold that all events of the table were filed with, if the table knows it."""
    names = [n for n in folder_names(spark, f"{path.rstrip('/')}/{SETTINGS}") if n.startswith("late_hours=")]
    return max((float(n.partition("=")[2]) for n in names), default=None)


def remember_late_hours(spark: SparkSession, path: str, hours: float) -> None:
    """Note the threshold of a batch beside the table, as the name of a folder.

    The largest one counts. A table that was filled before anything was noted
    stays unknown.
    """
    known = late_hours(spark, path)
    if known is None and has_data(spark, path) or known is not None and known >= hours:
        return
    make_folder(spark, f"{path.rstrip('/')}/{SETTINGS}/late_hours={float(hours)}")


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the date folders, those of compacted runs included; no file is listed."""
    names = set(partition_names(spark, path))
    for run in manifest.state(spark, path).runs:
        names |= set(partition_names(spark, f"{path}/{COMPACTED}/run={run}"))
    return sorted(n for n in names if n.startswith("date="))


def event_days(spark: SparkSession, path: str) -> list[str]:
    """Dates of the event table in ascending order; the late one is left out."""
    days = (n.removeprefix("date=") for n in partition_folders(spark, path))
    return [day for day in days if day != LATE_PARTITION]


def read_newest_events(spark: SparkSession, path: str) -> DataFrame:
    """The newest date partition and the late one.

    Enough for the newest event time, without reading the history.
    """
    return read_events(spark, path).where(F.col("date").isin([*event_days(spark, path)[-1:], LATE_PARTITION]))


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The JSON-lines mirror; timestamps are ISO text parsed by the schema."""
    return read_or_empty(spark, path, EVENT_TABLE_SCHEMA, "json")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """All rejected events, with the batch each was rejected in."""
    return read_batches(spark, path, DLQ_SCHEMA)


def read_ci_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, CI_RUN_SCHEMA)


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, CASE_SCHEMA)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, EMBEDDING_SCHEMA)


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, ANOMALY_SCHEMA)


def latest_dead_letters(dlq: DataFrame, limit: int = 20) -> DataFrame:
    """Newest rejected events first; ties by id."""
    return (
        dlq.select("event_id", "event_type", "error_reason", "raw_json", "failed_at")
        .orderBy(F.desc("failed_at"), "event_id")
        .limit(limit)
    )
