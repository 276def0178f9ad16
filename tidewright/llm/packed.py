"""Asking every other document about values, a packed block at a time.

Texts are dealt to chunks of some megabytes by a hash of id and text. A chunk
names values (64-bit hashes) and sends each distinct one once, packed by bucket;
a bucket meets the values of all chunks and answers each chunk with one bit per
value, in the order it was sent. So a value that a third of all documents hold
comes once from each chunk, no task holds more than a chunk or a bucket, and
answers are small enough to go back by chunk.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import as_bytes, release_memory

CHUNK_BYTES = 2 << 20
# Every chunk sends one message to every bucket, and there are as many buckets as
# chunks. So that messages do not dwindle, chunks grow with the root of all text,
# each message standing for this many bytes of it: their number follows the text.
MESSAGE_BYTES = 1536
NO_ID = np.iinfo(np.int64).max

MESSAGES = "bucket long, chunk long, kind int, body binary, docs binary"
ANSWERS = "chunk long, bucket long, kind int, body binary"


def chunk_bytes(size: int) -> int:
    """Bytes of text in a chunk: 2 MB up to 2.7 GB of text, 40 MB at 1 TB, 400 MB at 100 TB."""
    return max(CHUNK_BYTES, isqrt(size * MESSAGE_BYTES))


def chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk) and the number of chunks, which follows the size of all texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // chunk_bytes(size)) or 1
    return rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))), n


def in_order(chunk: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts of a chunk by (id, text), null ids last, null texts empty."""
    ids, texts = chunk.column("doc_id").to_pylist(), [t or b"" for t in as_bytes(chunk.column("text"))]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


def id_order(ids: list[int | None]) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def bucket_cuts(values: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted 64-bit values; buckets are ranges of values."""
    buckets = (values >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(buckets)) + 1
    starts = np.concatenate(([0], edges)) if len(values) else edges
    stops = np.append(edges, len(values)) if len(values) else edges
    return [(int(buckets[a]), a, b) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def low_bytes(values: np.ndarray, n: int) -> np.ndarray:
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def from_low_bytes(rows: np.ndarray) -> np.ndarray:
    full = np.zeros((len(rows), 8), np.uint8)
    full[:, : rows.shape[1]] = rows
    return full.view("<u8").reshape(-1)


def pack_ids(ids: np.ndarray) -> bytes:
    """Eight bytes of the least id, one of width, then differences of that width."""
    base = int(ids.min()) if len(ids) else 0
    apart = (ids.astype(np.int64).view(np.uint64) - np.uint64(base & 0xFFFFFFFFFFFFFFFF)).astype(np.uint64)
    kind = np.min_scalar_type(int(apart.max()) if len(ids) else 0)
    return base.to_bytes(8, "little", signed=True) + bytes([kind.itemsize]) + apart.astype(kind).tobytes()


def unpack_ids(held: bytes) -> np.ndarray:
    base, width = int.from_bytes(held[:8], "little", signed=True), held[8]
    apart = np.frombuffer(held, f"<u{width}", offset=9).astype(np.uint64)
    return (apart + np.uint64(base & 0xFFFFFFFFFFFFFFFF)).view(np.int64)


def messages(rows: list[tuple]) -> pa.Table:
    """(bucket, chunk, kind, body, docs) rows to a table; a chunk's last step."""
    release_memory()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["bucket", "chunk", "kind", "body", "docs"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def answers(rows: list[tuple]) -> pa.Table:
    """(chunk, bucket, kind, body) rows to a table; a bucket's last step."""
    release_memory()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "bucket", "kind", "body"])


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(held: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(held, np.uint8), count=n).astype(bool)


def value_messages(values: np.ndarray, counts: np.ndarray, chunk: int, n_buckets: int, kind: int = 0) -> list[tuple]:
    """Sorted distinct values, five bytes each, and how often the chunk holds them (one byte, 255 for more)."""
    often = np.minimum(counts, 255).astype(np.uint8)
    return [
        (bucket, chunk, kind, low_bytes(values[a:b], 5).tobytes(), often[a:b].tobytes())
        for bucket, a, b in bucket_cuts(values, n_buckets)
    ]


def value_answers(bucket: pa.Table, least: dict[int, int]) -> list[tuple]:
    """For every chunk and kind of answer, one bit per value: all chunks hold it `least[kind]` times or more."""
    rows = bucket.to_pylist()
    if not rows:
        return []
    sent = [np.frombuffer(r["body"], np.uint8).reshape(-1, 5) for r in rows]
    counts = np.concatenate([np.frombuffer(r["docs"], np.uint8) for r in rows])
    values = from_low_bytes(np.concatenate(sent))
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    total = np.empty(len(values), np.int64)
    total[order] = np.bincount(group, weights=counts[order])[group].astype(np.int64)
    out, at = [], 0
    for r, s in zip(rows, sent, strict=True):
        own = total[at : at + len(s)]
        out += [(r["chunk"], r["bucket"], kind, bits(own >= n)) for kind, n in least.items()]
        at += len(s)
    return out


def read_answers(values: np.ndarray, told: dict[int, bytes], n_buckets: int) -> np.ndarray:
    """The bits of `value_messages`' values."""
    flags = np.zeros(len(values), bool)
    for bucket, a, b in bucket_cuts(values, n_buckets):
        flags[a:b] = from_bits(told[bucket], b - a)
    return flags


def told(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {r["bucket"]: r["body"] for r in table.to_pylist() if r["kind"] == kind}
