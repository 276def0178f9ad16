"""File-system metadata through Hadoop's FileSystem, for any storage scheme."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class DataFile:
    path: str
    partition: str
    size: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def data_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> list[DataFile]:
    """Visible data files below a root with the name of their folder.

    Metadata only: names and sizes, nothing of the contents.
    """
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    found = []
    listing = fs.listFiles(path, True)
    prefix = fs.getFileStatus(path).getPath().toString().rstrip("/") + "/"
    while listing.hasNext():
        status = listing.next()
        full = status.getPath().toString()
        relative = full[len(prefix) :] if full.startswith(prefix) else full
        parts = relative.split("/")
        if any(part.startswith(("_", ".")) for part in parts) or not full.endswith(suffix):
            continue
        found.append(DataFile(full, parts[-2] if len(parts) > 1 else "", status.getLen()))
    return found


def partition_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the partition folders right below a root; no file is listed."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory())
    return sorted(name for name in names if "=" in name and not name.startswith(("_", ".")))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path, none if it is missing."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    return [status.getPath().getName() for status in fs.listStatus(root) if status.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.mkdirs(folder)


@dataclass(frozen=True)
class Folder:
    path: str
    values: dict[str, str]
    age_hours: float


def folders(spark: SparkSession, root: str, depth: int) -> list[Folder]:
    """Partition folders `depth` levels below a root with their values; no file is listed."""
    fs, path = _fs(spark, root)
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    level, now = [(path, {}, 0)], time.time()
    for _ in range(depth):
        below = []
        for folder, values, _ in level:
            for status in fs.listStatus(folder) if fs.exists(folder) else ():
                name = status.getPath().getName()
                if status.isDirectory() and "=" in name and not name.startswith(("_", ".")):
                    key, _, value = name.partition("=")
                    below.append((status.getPath(), values | {key: unescape(value)}, status.getModificationTime()))
        level = below
    return [Folder(folder.toString(), values, (now - changed / 1000) / 3600) for folder, values, changed in level]


def has_data(spark: SparkSession, root: str, suffix: str = ".parquet") -> bool:
    """True as soon as one visible data file turns up."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return False
    listing = fs.listFiles(path, True)
    while listing.hasNext():
        name = listing.next().getPath().toString()
        if name.endswith(suffix) and "/_" not in name[len(str(path)) :]:
            return True
    return False


def has_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")
