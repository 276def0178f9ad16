"""Raw-event streams. Every source yields `value` plus an arrival position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.sources import landed

# Flush after this many rows or seconds, whichever comes first.
FLUSH_ROWS = 100
FLUSH_SECONDS = 30


def kafka_options(
    servers: str, topic: str, flush_rows: int = FLUSH_ROWS, flush_seconds: int = FLUSH_SECONDS, max_rows: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(flush_rows),
        "maxTriggerDelay": f"{flush_seconds}s",
    }
    return options | ({"maxOffsetsPerTrigger": str(max_rows)} if max_rows else {})


def kafka_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    flush_rows: int = FLUSH_ROWS,
    flush_seconds: int = FLUSH_SECONDS,
    max_rows: int | None = None,
) -> DataFrame:
    """Topic from its earliest offset, or from the checkpoint when there is one.

    A batch starts once `flush_rows` are waiting or `flush_seconds` have gone
    by; `max_rows` bounds a batch after an outage. Needs Spark's Kafka package.
    """
    options = kafka_options(servers, topic, flush_rows, flush_seconds, max_rows)
    return spark.readStream.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("value"),
        F.struct("timestamp", "partition", "offset").alias("position"),
    )


def file_events(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Landed files with one raw event per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        ).alias("position"),
    )


def landed_events(
    spark: SparkSession, path: str, flush_rows: int = FLUSH_ROWS, flush_seconds: float = FLUSH_SECONDS
) -> DataFrame:
    """Landed files with one raw event per line, a batch per `flush_rows` waiting rows or `flush_seconds` of waiting.

    Start it with a short processing-time trigger: the source is asked at every
    trigger and stays idle until one of the two holds.
    """
    spark.dataSource.register(landed.LandedEvents)
    reader = spark.readStream.format(landed.NAME).options(flushRows=str(flush_rows), flushSeconds=str(flush_seconds))
    return reader.load(path).select("value", F.struct("modified", "file", "line").alias("position"))
