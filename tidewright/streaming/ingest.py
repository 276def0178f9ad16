"""Ingest: validate, dead-letter, deduplicate, route and store raw events.

`ingest_batch` is an ordinary batch function. A stream plans the parsing and
validation once and runs `store_judged` per micro-batch. Writing comes before
the checkpoint commit, so a failed batch is run again, and every write stands a
second run: events are anti-joined with the stored ids, dead letters and
metrics replace their own batch partition and may be written meanwhile. Dead
letters that their table does not take wait beside the events until they are
delivered. Counters and partial aggregates are
written before the events and, when a batch runs again, those of its first run
stand: by then its own events may be stored, and counting them anew would call
them repeats.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from tidewright.functions.time_bounds import to_micros
from tidewright.operators import rules
from tidewright.operators.dedupe import batch_span, first_per_key, known_ids, stored_candidates, undated_days
from tidewright.operators.flatten import event_columns, flatten, parse_raw, with_partition
from tidewright.schemas import DLQ_SCHEMA, LATE_PARTITION, LATE_THRESHOLD_HOURS
from tidewright.session import held, held_plainly, pin_utc
from tidewright.sources import manifest
from tidewright.sources.batches import is_rolled, replace_batch as _replace_batch, roll_up
from tidewright.sources.partials import roll_up_partials, write_partials
from tidewright.sources.sinks import append_events, append_events_jsonl, write_dead_letters
from tidewright.sources.files import delete, folders, has_data
from tidewright.sources.streams import FLUSH_SECONDS
from tidewright.sources.tables import BATCH, read_batches, read_events, remember_late_hours

log = logging.getLogger(__name__)


def utc_now() -> datetime:
    return datetime.now(tz=timezone.utc)


@dataclass(frozen=True)
class IngestPaths:
    """Target tables; all but the first two are optional.

    `partials` holds hourly aggregates for the incremental refresh and needs
    `counters`, by which a batch that runs again is recognised.
    """

    events: str
    dead_letters: str
    metrics: str | None = None
    counters: str | None = None
    partials: str | None = None

    def __post_init__(self) -> None:
        if self.partials and not self.counters:
            raise ValueError("partials need counters")

    @property
    def undated(self) -> str:
        """Ids of stored events without a usable time, with the day each was filed under."""
        return f"{self.events.rstrip('/')}_undated"

    @property
    def undelivered(self) -> str:
        """Dead letters that the dead-letter table did not take, by batch."""
        return f"{self.events.rstrip('/')}_undelivered"


def judge(raw: DataFrame) -> DataFrame:
    """Parse and validate raw texts (column `value`), batch or stream.

    Stateless, so a stream plans it once and not per micro-batch.
    """
    if "position" not in raw.columns:
        raw = raw.withColumn("position", F.lit(0))
    rejected = F.col("error_reason").isNotNull()
    return (
        rules.validate(parse_raw(raw))
        .withColumns(
            {
                "raw_json": F.when(rejected, F.coalesce("value", F.lit(""))),
                "raw_type": F.when(rejected, F.coalesce("ev.type", F.lit("unknown"))),
            }
        )
        .drop("value")
    )


def settle(
    judged: DataFrame, stamp: datetime, threshold_hours: float = LATE_THRESHOLD_HOURS
) -> DataFrame:
    """One row per raw text: flat columns, partition, verdict and metrics.

    The raw text is there for rejected rows only, so the batch is held once.
    """
    ingested_at = F.timestamp_micros(F.lit(to_micros(stamp)))
    ordered = judged.withColumn("_seq", F.monotonically_increasing_id())
    return with_partition(flatten(ordered, ingested_at), threshold_hours)


def rejected_rows(settled: DataFrame) -> DataFrame:
    return settled.where(F.col("error_reason").isNotNull()).select(
        "event_id",
        F.col("raw_type").alias("event_type"),
        "error_reason",
        "raw_json",
        F.col("ingested_at").alias("failed_at"),
    )


def stored_columns(settled: DataFrame) -> DataFrame:
    """Accepted rows with what deduplication and storage need."""
    return event_columns(rules.accepted(settled), "created_at_ok", "date", "position", "_seq")


COUNTERS = ("received", "dead_lettered", "skipped", "duplicate_in_batch", "already_stored", "late", "written")
# What the rows of a batch alone decide.
_OWN_COUNTERS = COUNTERS[:4]
COUNTERS_SCHEMA = ", ".join(f"{c} bigint" for c in COUNTERS)
METRICS_SCHEMA = "event_id string, event_type string, metrics map<string,string>"
UNDATED_SCHEMA = "event_id string, day string"


def _batch_folder(spark: SparkSession, path: str, batch: str) -> str:
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)
    return f"{path.rstrip('/')}/{BATCH}={name}"


def _first_counts(spark: SparkSession, path: str, batch: str) -> dict[str, int] | None:
    """Counters that an earlier run of the batch has written."""
    if not has_data(spark, _batch_folder(spark, path, batch)) and not is_rolled(spark, path, batch):
        return None
    row = read_batches(spark, path, COUNTERS_SCHEMA).where(F.col(BATCH) == batch).drop(BATCH).first()
    return row.asDict() if row else None


def _undated_index(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """Ids of stored undated events.

    For a table that is older than its index it is built and stored once:
    undated events carry their ingest time.
    """
    known = has_data(spark, paths.undated) or manifest.state(spark, paths.undated).runs
    if not known and has_data(spark, paths.events):
        old = read_events(spark, paths.events).where("created_at = ingested_at")
        _replace_batch(old.select("event_id", F.col("date").alias("day")), paths.undated, "before-the-index")
    return read_batches(spark, paths.undated, UNDATED_SCHEMA)


def ingest_batch(
    raw: DataFrame,
    paths: IngestPaths,
    batch: str,
    threshold_hours: float = LATE_THRESHOLD_HOURS,
    stamp: datetime | None = None,
) -> dict[str, int]:
    """Store one batch of raw JSON texts (column `value`) and count what happened."""
    return store_judged(judge(raw), paths, batch, threshold_hours, stamp)


def _store_rejected(settled: DataFrame, paths: IngestPaths, batch: str) -> None:
    spark, rows = settled.sparkSession, rejected_rows(settled)
    try:
        write_dead_letters(rows, paths.dead_letters, batch)
    except Exception:
        # A failing dead-letter table must not stop the stream, nor lose a row: if these can't wait
        # beside the events either, the batch fails.
        log.exception("dead-letter write failed for batch %s", batch)
        _replace_batch(rows, paths.undelivered, batch)
        return
    # What an earlier run of the batch left there.
    delete(spark, _batch_folder(spark, paths.undelivered, batch))
    try:
        deliver_dead_letters(spark, paths)
    except Exception:
        log.exception("dead letters are still waiting in %s", paths.undelivered)


def deliver_dead_letters(spark: SparkSession, paths: IngestPaths) -> int:
    """Store the dead letters that wait beside the events; the number of their batches.

    Fails when the dead-letter table does not take them; they go on waiting then.
    """
    waiting = [folder for folder in folders(spark, paths.undelivered, 1) if BATCH in folder.values]
    for folder in waiting:
        rows = spark.read.schema(DLQ_SCHEMA).parquet(folder.path)
        write_dead_letters(rows, paths.dead_letters, folder.values[BATCH])
        delete(spark, folder.path)
    return len(waiting)


def _store_metrics(settled: DataFrame, paths: IngestPaths, batch: str) -> None:
    metrics = rules.accepted(settled).select(
        "event_id",
        "event_type",
        F.map_filter("metrics", lambda k, _: k != "event_type").alias("metrics"),
    )
    _replace_batch(metrics, paths.metrics, batch)


def store_judged(
    judged: DataFrame,
    paths: IngestPaths,
    batch: str,
    threshold_hours: float = LATE_THRESHOLD_HOURS,
    stamp: datetime | None = None,
) -> dict[str, int]:
    """The part of the ingest that runs once per batch."""
    spark = pin_utc(judged.sparkSession)
    # Held rows are read a few times, then dropped.
    with held_plainly(spark):
        return _store(spark, judged, paths, batch, threshold_hours, stamp or utc_now())


def _store(
    spark: SparkSession, judged: DataFrame, paths: IngestPaths, batch: str, threshold_hours: float, stamp: datetime
) -> dict[str, int]:
    settled = held(settle(judged, stamp, threshold_hours))
    marked = None
    pool, beside = ThreadPoolExecutor(2), []
    try:
        passed = F.col("error_reason").isNull() & ~F.coalesce(F.col("skipped"), F.lit(False))
        own = settled.withColumns({c: F.when(passed, F.col(c)) for c in ("created_at", "created_at_ok", "date")})
        seen = own.agg(
            F.count("*").alias("received"),
            F.count_if(F.col("error_reason").isNotNull()).alias("dead_lettered"),
            F.count_if(F.col("skipped")).alias("skipped"),
            *batch_span(),
        ).first()
        accepted = seen["received"] - seen["dead_lettered"] - seen["skipped"]
        # Small next to the events and apart from them, so they fill the cores that the steps below leave idle.
        if seen["dead_lettered"]:
            beside.append(pool.submit(inheritable_thread_target(spark)(_store_rejected), settled, paths, batch))
        if paths.metrics:
            beside.append(pool.submit(inheritable_thread_target(spark)(_store_metrics), settled, paths, batch))
        kept = {"unique": 0, "late": 0, "written": 0}
        if accepted:
            rows = stored_columns(settled)
            first = first_per_key(rows, "event_id", "position", "_seq")
            days = undated_days(rows, _undated_index(spark, paths)) if seen["undated"] else []
            stored = stored_candidates(read_events(spark, paths.events), seen, days)
            repeated = known_ids(rows, stored).withColumn("_stored", F.lit(True))
            # Held, so that counting and writing see the same rows.
            marked = held(
                first.join(repeated, "event_id", "left").withColumn("_stored", F.col("_stored").isNotNull())
            )
            kept = marked.agg(
                F.count("*").alias("unique"),
                F.count_if(F.col("date") == LATE_PARTITION).alias("late"),
                F.count_if(~F.col("_stored")).alias("written"),
            ).first()
        counts = {
            "received": seen["received"],
            "dead_lettered": seen["dead_lettered"],
            "skipped": seen["skipped"],
            "duplicate_in_batch": accepted - kept["unique"],
            "already_stored": kept["unique"] - kept["written"],
            "late": kept["late"],
            "written": kept["written"],
        }
        if paths.counters:
            before = _first_counts(spark, paths.counters, batch)
            if before and all(before[c] == counts[c] for c in _OWN_COUNTERS):
                counts = before
            else:
                if paths.partials and kept["written"]:
                    # Before the counters, so that they never stand without the partials.
                    new = event_columns(marked.where(~F.col("_stored")), "date")
                    write_partials(new, paths.partials, batch)
                row = spark.range(1, numPartitions=1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])
                _replace_batch(row, paths.counters, batch)
        if kept["written"]:
            remember_late_hours(spark, paths.events, threshold_hours)
            new = marked.where(~F.col("_stored"))
            if seen["undated"]:
                # Before the events: an id too many only names a day to look in.
                ids = new.where(~F.col("created_at_ok")).select("event_id", F.col("date").alias("day"))
                _replace_batch(ids.hint("rebalance"), paths.undated, batch)
            append_events(new, paths.events)
        for write in beside:
            write.result()
        log.info("batch %s: %s", batch, counts)
        return counts
    finally:
        pool.shutdown()
        if marked is not None:
            marked.unpersist()
        settled.unpersist()


def ingest_jsonl(
    raw: DataFrame,
    path: str,
    threshold_hours: float = LATE_THRESHOLD_HOURS,
    stamp: datetime | None = None,
) -> None:
    """Append flat events to the JSON-lines mirror: no validation, no dedupe."""
    pin_utc(raw.sparkSession)
    stamp = stamp or utc_now()
    ingested_at = F.timestamp_micros(F.lit(to_micros(stamp)))
    append_events_jsonl(
        with_partition(flatten(parse_raw(raw), ingested_at), threshold_hours), path
    )


def start_ingest(
    stream: DataFrame,
    paths: IngestPaths,
    checkpoint: str,
    stream_id: str,
    threshold_hours: float = LATE_THRESHOLD_HOURS,
    flush_seconds: int | None = FLUSH_SECONDS,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Run the ingest; `flush_seconds=None` drains what is there and stops.

    `stream_id` names the checkpoint, so batch ids of two streams do not meet.
    `clock` gives the ingest stamp of a batch.
    """

    def sink(batch_rows: DataFrame, batch_id: int) -> None:
        store_judged(batch_rows, paths, f"{stream_id}-{batch_id}", threshold_hours, clock())

    writer = (
        judge(stream)
        .writeStream.queryName(stream_id)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    if flush_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{flush_seconds} seconds").start()


def ingest_counters(spark: SparkSession, path: str) -> DataFrame:
    """Totals over all batches."""
    rows = read_batches(spark, path, COUNTERS_SCHEMA)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])


def roll_up_batches(spark: SparkSession, paths: IngestPaths, unchanged_hours: float = 24) -> dict[str, int]:
    """Merge the partitions of sealed batches in every batch table; batches merged per table.

    Dead letters that wait beside the events are delivered first.
    """
    deliver_dead_letters(spark, paths)
    done = {
        "dead_letters": roll_up(spark, paths.dead_letters, DLQ_SCHEMA, None, unchanged_hours),
        "undated": roll_up(spark, paths.undated, UNDATED_SCHEMA, None, unchanged_hours),
    }
    if paths.metrics:
        done["metrics"] = roll_up(spark, paths.metrics, METRICS_SCHEMA, None, unchanged_hours)
    if paths.counters:
        done["counters"] = roll_up(spark, paths.counters, COUNTERS_SCHEMA, None, unchanged_hours)
    if paths.partials:
        done["partials"] = roll_up_partials(spark, paths.partials, unchanged_hours)
    return done
