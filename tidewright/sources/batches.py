"""Tables with one partition per ingest batch, and their roll-up.

A batch that runs again replaces its partition. Many small partitions are merged
once their batches are sealed: the rows move to a run of the table (`manifest`)
and a ledger names the batches in it, so a batch that is replayed after that is
recognised and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewright.sources import manifest
from tidewright.sources.files import delete, folders, partition_names
from tidewright.sources.tables import BATCH, read_or_empty, with_batch


def is_rolled(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether the ledger names the batch; without a roll-up this is one look at the file system."""
    runs = manifest.state(spark, path).runs
    if not runs:
        return False
    ledger = spark.read.schema(f"{BATCH} string, run string").parquet(f"{path}/_ledger")
    return not ledger.where(F.col("run").isin(*runs) & (F.col(BATCH) == batch)).isEmpty()


def partition_days(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the partition column above the batch in ascending order, those of rolled-up batches included."""
    names = set(partition_names(spark, path))
    for run in manifest.state(spark, path).runs:
        names |= set(partition_names(spark, f"{path}/_rolled/run={run}"))
    return sorted(n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}="))


def replace_batch(rows: DataFrame, path: str, batch: str, by: list[str] | None = None) -> None:
    """Write the rows of one batch under their own partition, in place of those of an earlier run."""
    if is_rolled(rows.sparkSession, path, batch):
        return
    named = rows.withColumn(BATCH, F.lit(batch))
    (
        (named.hint("rebalance", *map(F.col, by)) if by else named)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(by or []), BATCH)
        .parquet(path)
    )


def _sweep(spark: SparkSession, path: str, depth: int) -> manifest.State:
    """Delete what the manifest has dropped, and strike it off."""
    known = manifest.state(spark, path)
    if not known.drops:
        return known
    gone = set(known.drops)
    for folder in folders(spark, path, depth):
        if folder.values.get(BATCH) in gone:
            delete(spark, folder.path)
    manifest.commit(spark, path, known.swept())
    return manifest.state(spark, path)


def roll_up(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    by: list[str] | None = None,
    unchanged_hours: float = 24,
) -> int:
    """Merge the partitions of batches that nothing has changed for some hours; their number.

    `by` names partition columns above the batch; the merged rows keep them.
    """
    by = by or []
    known = _sweep(spark, path, len(by) + 1)
    newest: dict[str, float] = {}
    for folder in folders(spark, path, len(by) + 1):
        if BATCH in folder.values:
            name = folder.values[BATCH]
            newest[name] = min(newest.get(name, float("inf")), folder.age_hours)
    sealed = sorted(name for name, age in newest.items() if age >= unchanged_hours)
    if len(sealed) < 2:
        return 0
    run = manifest.new_run()
    rows = read_or_empty(spark, path, with_batch(schema)).where(F.col(BATCH).isin(*sealed))
    rows.hint("rebalance", *map(F.col, by)).write.partitionBy(*by).parquet(f"{path}/_rolled/run={run}")
    ledger = spark.createDataFrame([(name,) for name in sealed], f"{BATCH} string")
    ledger.coalesce(1).write.parquet(f"{path}/_ledger/run={run}")
    manifest.commit(spark, path, known.after(run, sealed))
    _sweep(spark, path, len(by) + 1)
    return len(sealed)
