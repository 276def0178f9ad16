"""Token ids in byte-aligned variable-length coding.

Ids are replaced by their rank in the order of falling corpus frequency, so
common ids take one byte. A block holds control bytes apart from data bytes:
each control byte has the lengths (1 to 4, two bits each) of four ranks, whose
little-endian bytes stand in the data. Decoding looks the lengths up in a table
of 256 rows and gathers the data bytes with numpy.

Layout of an output folder (Parquet is the container, so that Spark's commit
protocol holds on any storage and lost executors leave nothing half-written):

* `ranks/`: `rank`, `id`, one row per id of the vocabulary;
* `blocks/`: one row per block of consecutive documents in ascending id order:
  `part`, `first` (number of the block's first document in its part), `before`
  (ids of the part before the block), `n_ids`, `doc_ids` (int64, little-endian),
  `no_id` (one byte per document, 1 for a null id), `counts` (uint32 ids per
  document), `control`, `data`.

Texts are encoded once, by way of their distinct words (`word_ids`).

Defined cases: null text is empty and yields the end id alone; documents are
ordered by (id, hash of the text) with null ids first, so repeated rows are all
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm.common import as_bytes, slices, tidy
from tidewright.llm.word_ids import SLICE_BYTES, WordEncoder, ids_column, tokenizer_path, worker_encoder
from tidewright.session import work_dir

END_ID = 1
BLOCK_IDS = 1 << 18

TOKENS = "part int, seq long, before long, doc_id long, ids binary"
BLOCKS = (
    "part int, first long, before long, n_ids long, doc_ids binary, no_id binary, counts binary, control binary, data binary"
)
READ = "doc_id long, part int, in_part long, n_tokens long, ids binary"


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, END_ID)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids, counts = encoder.encode_all(as_bytes(batch.column("text")))
                n = len(counts)
                starts = before + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.arange(seq, seq + n, dtype=np.int64)),
                        pa.array(starts),
                        batch.column("doc_id"),
                        ids_column(ids, counts),
                    ],
                    names=["part", "seq", "before", "doc_id", "ids"],
                )
                seq += n
                before += int(counts.sum())

    return tidy(run)


def _count(dtype: np.dtype, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            held = b"".join(batch.column("ids").to_pylist())
            total += np.bincount(np.frombuffer(held, dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return tidy(run)


_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    stops = np.cumsum(lengths, dtype=np.int64)
    at = stops - lengths
    data = np.empty(int(stops[-1]) if len(stops) else 0, np.uint8)
    data[at] = values.astype(np.uint8)
    for k in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > k)
        data[at[longer] + k] = (values[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The `n` values of a block."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    held = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    values = held[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= held[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _blocks(dtype: np.dtype, rank_of):
    """Consecutive documents of one part to blocks; what is held stays near BLOCK_IDS ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_of.value
        kinds = [pa.int32()] + [pa.int64()] * 3 + [pa.binary()] * 5
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        held, n_ids, key = [], 0, None

        def flush():
            part, first, before = held[0][:3]
            ids = np.frombuffer(b"".join([h[4] for h in held]), dtype)
            control, data = pack(ranks[ids])
            doc_ids = np.array([h[3] or 0 for h in held], "<i8").tobytes()
            counts = np.array([len(h[4]) // dtype.itemsize for h in held], "<u4").tobytes()
            row = (part, first, before, len(ids), doc_ids, bytes(h[3] is None for h in held), counts, control, data)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("part", "seq", "before", "doc_id", "ids")], strict=True):
                if held and (key != (row[0], row[1]) or n_ids >= BLOCK_IDS):
                    yield flush()
                    held, n_ids = [], 0
                held.append(row)
                n_ids += len(row[4]) // dtype.itemsize
                key = (row[0], row[1] + 1)
        if held:
            yield flush()

    return tidy(run)


def write_tokens(docs: DataFrame, out: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the folder described above."""
    path = path or tokenizer_path()
    spark = docs.sparkSession
    encoder = WordEncoder(path, END_ID)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = f"{out}/tokens"
    (
        rows.repartitionByRange(n, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
        .mapInArrow(_encode(path), TOKENS)
        .write.option("compression", "zstd")
        .parquet(tokens)
    )
    held = spark.read.schema(TOKENS).parquet(tokens)
    counts = (
        held.select("ids").mapInArrow(_count(encoder.dtype, encoder.size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    )
    # One row per id of the vocabulary at most.
    seen = np.zeros(encoder.size, np.int64)
    for row in counts.collect():
        seen[row.id] = row.n
    by_rank = np.lexsort((np.arange(encoder.size), -seen))
    rank_of = np.empty(encoder.size, np.uint32)
    rank_of[by_rank] = np.arange(encoder.size, dtype=np.uint32)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank int, id int").coalesce(1).write.parquet(
        f"{out}/ranks"
    )
    shared = spark.sparkContext.broadcast(rank_of)
    held.mapInArrow(_blocks(encoder.dtype, shared), BLOCKS).write.option("compression", "zstd").parquet(f"{out}/blocks")


def _decode(id_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_rank = id_of.value
        for batch in batches:
            for b in batch.to_pylist():
                counts = np.frombuffer(b["counts"], "<u4").astype(np.int64)
                ids = ids_of_rank[unpack(b["control"], b["data"], int(counts.sum()))]
                stops = np.cumsum(counts)
                raw = ids.tobytes()
                doc_ids = np.frombuffer(b["doc_ids"], "<i8")
                missing = np.frombuffer(b["no_id"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=missing),
                        pa.array(np.full(len(counts), b["part"], np.int32)),
                        pa.array(b["before"] + stops - counts),
                        pa.array(counts),
                        pa.array([raw[4 * (e - c) : 4 * e] for e, c in zip(stops.tolist(), counts.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "part", "in_part", "n_tokens", "ids"],
                )

    return tidy(run)


def _stored_blocks(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{out}/blocks")


def _decoder(spark: SparkSession, out: str):
    """Task function from blocks of the folder to rows of `READ`."""
    ranks = spark.read.parquet(f"{out}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for row in ranks:
        id_of[row["rank"]] = row["id"]
    return _decode(spark.sparkContext.broadcast(id_of))


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, part, in_part (ids of the part before the document), n_tokens, ids (uint32, little-endian)."""
    return _stored_blocks(spark, out).mapInArrow(_decoder(spark, out), READ)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "part", "in_part", "n_tokens")), pa.array(crcs, pa.int64())],
            names=["doc_id", "part", "in_part", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, out: str) -> DataFrame:
    """Per document, read from the files: start among all ids, number of ids, checksum."""
    blocks = _stored_blocks(spark, out)
    decode = _decoder(spark, out)
    totals = blocks.groupBy("part").agg(F.max(F.col("before") + F.col("n_ids")).alias("n")).orderBy("part").collect()
    starts, at = [], 0
    for row in totals:
        starts.append((row.part, at))
        at += row.n
    # One row per written partition, whose number spark.sql.shuffle.partitions fixes.
    bases = F.broadcast(spark.createDataFrame(starts, "part int, base long"))
    # Read and digested by one worker a task: ids don't go through the JVM, and no second worker stays behind.
    rows = blocks.mapInArrow(
        lambda batches: _digest(decode(batches)), "doc_id long, part int, in_part long, n_tokens long, ids_crc32 long"
    )
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded_documents(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", out: str | None = None
) -> DataFrame:
    """Write the documents' ids to the folder `out`, a fresh work folder unless given, and return what reading it gives."""
    spark = docs.sparkSession
    out = out or work_dir(spark, "token-output")
    write_tokens(docs, out, path, id_col, text_col)
    return token_digests(spark, out)
