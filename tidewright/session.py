"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def build_session(
    app_name: str = "tidewright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the settings every job here relies on.

    `shuffle_partitions` stays unset on a cluster: adaptive execution starts
    from the cluster's own number and coalesces from there.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Date keys and hour buckets are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder named by `spark.checkpoint.dir`.

    The setting names storage every executor can reach; it can't be changed at
    run time. Where it is unset one temporary folder a process is used, which is
    only right when driver and executors share one machine, so any master but
    `local[...]` is refused.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_root = root = _local_root or tempfile.mkdtemp(prefix="tidewright-")
    return f"{root.rstrip('/')}/tidewright/{purpose}-{uuid.uuid4().hex}"


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """Store a result that several later steps read, and return the stored table.

    It is computed once, and a lost executor costs a re-read instead of a
    recomputation.
    """
    path = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def held(rows: DataFrame) -> DataFrame:
    """Persist a result that adaptive execution may cut into as few tasks as its size needs.

    A held plan otherwise keeps every shuffle partition, so each step that reads
    it pays for that many tasks, and their own shuffles for the square of it.
    """
    conf, key = rows.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return rows.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    finally:
        conf.set(key, before)


@contextmanager
def held_plainly(spark: SparkSession) -> Iterator[None]:
    """Inside, held results are kept without compression.

    Compressing counts the values of every column first, which costs more than
    a result that is read a few times and dropped gives back.
    """
    key = "spark.sql.inMemoryColumnarStorage.compressed"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
