"""Compaction, dead-letter replay and backfill of the event table."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewright.schemas import EVENT_TABLE_SCHEMA, LATE_PARTITION, LATE_THRESHOLD_HOURS
from tidewright.sources import manifest, tables
from tidewright.sources.files import DataFile, data_files, delete
from tidewright.sources.tables import read_dead_letters, read_or_empty
from tidewright.streaming.ingest import IngestPaths, deliver_dead_letters, ingest_batch

MIN_FILES = 2
TARGET_FILE_BYTES = 512 * 1024 * 1024
# Files handled in one job.
FILES_PER_JOB = 20_000

SUMMARY_SCHEMA = (
    "partition string, skipped boolean, files_before bigint, files_after bigint, "
    "rows bigint, output_paths array<string>"
)


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """Date partitions with their files and rows, from the table itself; `date=late` sorts last."""
    named = tables.read_event_files(spark, path)
    return (
        named.groupBy("date")
        .agg(F.countDistinct("file_name").alias("files"), F.count("*").alias("rows"))
        .select(F.concat(F.lit("date="), "date").alias("partition"), "files", "rows")
        .orderBy("partition")
    )


def partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the date partitions in ascending order; `date=late` sorts last."""
    late = [f"date={LATE_PARTITION}"] if f"date={LATE_PARTITION}" in tables.partition_folders(spark, path) else []
    return [f"date={day}" for day in tables.event_days(spark, path)] + late


def _name(file: DataFile) -> str:
    """As `tables.read_event_files` names it; a run's files carry the id of the job that wrote them."""
    return f"{file.partition}/{file.path.rpartition('/')[2]}"


def live_files(spark: SparkSession, path: str) -> list[DataFile]:
    """Files whose rows count, compacted ones included."""
    known = manifest.state(spark, path)
    found = data_files(spark, path)
    for run in known.runs:
        found += data_files(spark, f"{path}/{tables.COMPACTED}/run={run}")
    dropped = set(known.drops)
    return [f for f in found if _name(f) not in dropped]


def _sweep(spark: SparkSession, path: str) -> manifest.State:
    """Delete the files that the manifest has dropped, and strike them off."""
    known = manifest.state(spark, path)
    if not known.drops:
        return known
    dropped = set(known.drops)
    found = data_files(spark, path)
    for run in known.runs:
        found += data_files(spark, f"{path}/{tables.COMPACTED}/run={run}")
    for file in found:
        if _name(file) in dropped:
            delete(spark, file.path)
    manifest.commit(spark, path, known.swept())
    return manifest.state(spark, path)


def _jobs(groups: dict[str, list[DataFile]]) -> list[list[str]]:
    """Partitions packed into jobs by their number of files."""
    jobs: list[list[str]] = [[]]
    size = 0
    for name in sorted(groups):
        if jobs[-1] and size + len(groups[name]) > FILES_PER_JOB:
            jobs.append([])
            size = 0
        jobs[-1].append(name)
        size += len(groups[name])
    return [job for job in jobs if job]


def _merge(
    spark: SparkSession, path: str, groups: dict[str, list[DataFile]], target_bytes: int
) -> list[tuple]:
    """Write the rows of the listed files as one run, switch to it, then delete the originals.

    The switch is one rename of a manifest version: a reader sees each row once
    before, at and after it. Files that are appended meanwhile stay.
    """
    known, run = _sweep(spark, path), manifest.new_run()
    out = f"{path}/{tables.COMPACTED}/run={run}"
    # A session of its own: the target size must not change what others plan.
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    listed = [f for files in groups.values() for f in files]
    plain = [f.path for f in listed if f"/{tables.COMPACTED}/" not in f.path]
    before = [f.path for f in listed if f"/{tables.COMPACTED}/" in f.path]
    columns = EVENT_TABLE_SCHEMA.names
    parts = []
    if plain:
        parts.append(own.read.option("basePath", path).schema(EVENT_TABLE_SCHEMA).parquet(*plain))
    if before:
        schema = T.StructType([*EVENT_TABLE_SCHEMA.fields, T.StructField("run", T.StringType())])
        again = own.read.option("basePath", f"{path}/{tables.COMPACTED}").schema(schema).parquet(*before)
        parts.append(again.select(*columns))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    (
        rows.hint("rebalance", F.col("date"))
        .write.option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#event_id", "true")
        .partitionBy("date")
        .parquet(out)
    )
    # One row per date.
    written = spark.read.schema(EVENT_TABLE_SCHEMA).parquet(out).groupBy("date").agg(F.count("*").alias("n"))
    counts = {f"date={r['date']}": r["n"] for r in written.collect()}
    fresh: dict[str, list[str]] = defaultdict(list)
    for file in data_files(spark, out):
        fresh[file.partition].append(file.path)
    manifest.commit(spark, path, known.after(run, [_name(f) for f in listed]))
    _sweep(spark, path)
    return [
        (name, False, len(files), len(fresh[name]), counts.get(name, 0), fresh[name]) for name, files in groups.items()
    ]


def compact(
    spark: SparkSession,
    path: str,
    min_files: int = MIN_FILES,
    target_bytes: int = TARGET_FILE_BYTES,
    only: list[str] | None = None,
) -> DataFrame:
    """Merge small files per date partition; summary rows per partition.

    A partition below `target_bytes` becomes one file, a larger one several
    files of about that size written by as many tasks. `only` names the
    partitions to look at; one compaction of a table runs at a time.
    """
    path = path.rstrip("/")
    groups: dict[str, list[DataFile]] = defaultdict(list)
    for file in live_files(spark, path):
        if file.partition.startswith("date=") and (only is None or file.partition in only):
            groups[file.partition].append(file)
    small = {name: files for name, files in groups.items() if len(files) < min_files}
    todo = {name: files for name, files in groups.items() if len(files) >= min_files}
    summary = [(name, True, len(files), len(files), 0, None) for name, files in small.items()]
    for job in _jobs(todo):
        summary += _merge(spark, path, {name: todo[name] for name in job}, target_bytes)
    return spark.createDataFrame(sorted(summary, key=lambda r: r[0]), SUMMARY_SCHEMA)


def compaction_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if(~F.col("skipped")).alias("compacted"),
        F.count_if(F.col("skipped")).alias("skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )


def replay_dead_letters(
    spark: SparkSession,
    dead_letter_path: str,
    paths: IngestPaths,
    batch: str,
    where: Column | None = None,
    threshold_hours: float = LATE_THRESHOLD_HOURS,
    stamp: datetime | None = None,
) -> dict[str, int]:
    """Send the stored raw texts through validation and storage again.

    What fails again lands in `paths.dead_letters`, what passes in the events.
    A dead letter that could not be stored there fails the replay.
    """
    rows = read_dead_letters(spark, dead_letter_path)
    chosen = rows if where is None else rows.where(where)
    raw = chosen.select(
        F.col("raw_json").alias("value"), F.struct("failed_at", "event_id").alias("position")
    )
    counts = ingest_batch(raw, paths, batch, threshold_hours, stamp)
    deliver_dead_letters(spark, paths)
    return counts


def backfill(
    spark: SparkSession,
    source: str,
    source_schema: T.StructType,
    target: str,
    columns: dict[str, Column],
    dates: list[str] | None = None,
) -> None:
    """Rewrite old partitions in a new layout.

    `columns` maps each target column to an expression over the old schema and
    has to include `date`. Partitions of the target that receive rows are
    replaced, the others stay.
    """
    old = read_or_empty(spark, source, source_schema)
    if dates is not None:
        old = old.where(F.col("date").isin(dates))
    (
        old.select(*[expr.alias(name) for name, expr in columns.items()])
        .hint("rebalance", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(target)
    )
