"""Words, digests and table access shared by the training-data operators."""

from __future__ import annotations

import ctypes
import itertools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Characters that part words, as regular-expression classes.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else (b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20)
    for b in range(256)
)


_shipped: set[str] = set()


BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the package's code to the executors of this application, once, through Spark's own file server.

    Texts go to Python in batches of some megabytes, as large ones are held
    several times over on both sides.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidewright-code-")) / "tidewright-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, unchanged. `bytes.split` cuts at exactly those six bytes."""
    return text.split() if text else []


def folded_space_words(text: bytes | None) -> list[bytes]:
    """As `space_words`, with A-Z in lower case; other letters stay as they are."""
    return text.lower().split() if text else []


def folded_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII digits, letters (A-Z in lower case) and all non-ASCII characters."""
    return text.translate(_FOLD).split() if text else []


def release_memory() -> None:
    """Hand freed memory back to the system; Spark keeps Python workers alive between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task function that leaves no freed memory behind."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A text column as UTF-8 without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def count_words(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.when(
        text.isNotNull(), F.size(F.array_remove(F.split(text, SPACE), ""))
    ).otherwise(0).cast("long")


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each, at least one row."""
    sizes = [len(x) if x else 0 for x in as_bytes(batch.column(column))]
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def picked(rows: DataFrame, **columns: str) -> DataFrame:
    """Columns by their exact names under new ones, whatever else the table holds."""
    numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return numbered.select(*[F.col(f"c{rows.columns.index(old)}").alias(new) for new, old in columns.items()])


def free_names(taken: list[str], wanted: tuple[str, ...] | list[str]) -> list[str]:
    """The wanted names, numbered where the table has them already in any case."""
    used, out = {name.lower() for name in taken}, []
    for name in wanted:
        free = next(n for k in itertools.count() if (n := f"{name}_{k}" if k else name).lower() not in used)
        used.add(free.lower())
        out.append(free)
    return out


def first_columns(rows: DataFrame, names: list[str], keep: Callable[[Column], Column]) -> DataFrame:
    """The rows whose last column meets `keep`, with their first columns under the given names."""
    numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    kept = numbered.where(keep(F.col(f"c{len(rows.columns) - 1}")))
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


# Rows of a few numbers each that every executor may hold.
BROADCAST_ROWS = 500_000


def small_or_shuffled(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, broadcast in joins if it has no more rows than that; larger ones are shuffled."""
    return F.broadcast(stored) if stored.count() <= rows else stored
