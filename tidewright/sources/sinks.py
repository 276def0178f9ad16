"""Table writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tidewright.operators.flatten import event_columns
from tidewright.sources.batches import replace_batch
from tidewright.sources.files import delete, has_path, move


def _by_date(rows: DataFrame) -> DataFrame:
    """Group rows by date for writing.

    The rebalance hint lets adaptive execution cut a date that outgrows the
    advisory partition size into several tasks; a small date stays one file.
    """
    return rows.hint("rebalance", F.col("date"))


def append_events(events: DataFrame, path: str) -> None:
    """Append to the date-partitioned Parquet event table.

    The id column carries a Bloom filter so later id look-ups can skip row
    groups.
    """
    (
        _by_date(event_columns(events, "date"))
        .write.mode("append")
        .option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#event_id", "true")
        .partitionBy("date")
        .parquet(path)
    )


def append_events_jsonl(events: DataFrame, path: str) -> None:
    """Append to the date-partitioned JSON-lines mirror, duplicates kept."""
    (
        _by_date(event_columns(events, "date"))
        .write.mode("append")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("ignoreNullFields", "false")
        .partitionBy("date")
        .json(path)
    )


def write_dead_letters(rows: DataFrame, path: str, batch: str) -> None:
    """Write the rejected events of one batch under their own partition.

    Running the same batch again replaces that partition, so a replay adds
    nothing twice.
    """
    replace_batch(rows, path, batch)


def overwrite(rows: DataFrame, path: str) -> None:
    """Replace a whole table (CI runs, cases, embeddings)."""
    rows.write.mode("overwrite").parquet(path)


def swap_in(rows: DataFrame, path: str) -> None:
    """Replace a small result table by renaming, so readers find the old or the new one."""
    spark = rows.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    fresh, old = (f"{parent}/_{kind}-{name}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    rows.coalesce(1).write.parquet(fresh)
    if has_path(spark, path):
        move(spark, path, old)
    move(spark, fresh, path)
    delete(spark, old)
