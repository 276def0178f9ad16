"""Packing documents into sequences by vector best-fit.

A piece asks for three things: tokens, one document, and attention cost (its
length squared, as attention stays within a document). A sequence has a
capacity of each. Pieces are taken in order of falling length, and each goes to
the open sequence that has room for it in every respect and is tightest: by the
weighted norm of what would be left over (`norm`), or by the weighted dot
product of the piece with what is left (`dot`). If there is none, a new one is
opened.

All three demands follow from the length, so pieces of one length are
interchangeable, and so are sequences with the same remains. That is why the
whole choice follows from the count of every length, at most as many rows as a
sequence has tokens, for any number of documents: equal sequences are filled in
one step, exactly as one by one. A step says which pieces of a length (by their
number among all of that length) go where, and the pieces find their place by a
join with the steps. No document, and nothing that grows with them, reaches the
driver.

Pieces are numbered where they are encoded: a task counts its pieces by length,
and the counts of the tasks before it are added afterwards.

Defined cases: null text is empty and yields the end id alone; repeated rows
and rows without an id are packed like any others; an empty table gives an
empty result; only pieces of documents longer than a sequence are cut; other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.llm.common import as_bytes, picked, slices, tidy
from tidewright.llm.word_ids import SLICE_BYTES, ids_column, tokenizer_path, worker_encoder
from tidewright.session import work_dir, written

END_ID = 0

_PIECES = "part int, nth long, doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"
_STEPS = "length int, first long, past long, each int, sequence long, place int"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most; without a bound of their own, documents and attention never bind before tokens."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    # Of tokens, documents and attention in the choice of a sequence.
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    score: str = "norm"

    @property
    def bounds(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.attention or self.tokens**2

    @property
    def longest_piece(self) -> int:
        return min(self.tokens, math.isqrt(self.bounds[2]))


def steps(counts: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple]:
    """(length, first, past, each, sequence, place) of every step.

    Pieces of a length with numbers from `first` to before `past` go to
    consecutive sequences from `sequence` on, `each` to a sequence, one after the
    other from `place` on.
    """
    bounds = np.array(capacity.bounds, np.float64)
    weights = np.array(capacity.weights, np.float64)
    left = np.zeros((0, 3), np.int64)  # what is left in the sequences of a class
    where = np.zeros((0, 2), np.int64)  # its first sequence and how many there are
    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], np.int64)
        number, past = 0, counts[length]
        while number < past:
            fits = (left >= demand).all(axis=1)
            if fits.any():
                own = np.flatnonzero(fits)
                rest = left[own] / bounds
                part = demand / bounds
                if capacity.score == "norm":
                    tight = ((rest - part) ** 2 * weights).sum(axis=1)
                else:
                    tight = (rest * part * weights).sum(axis=1)
                best = int(own[np.argmin(tight)])
                remains, (sequence, n) = left[best].copy(), where[best].tolist()
            else:
                best, remains, sequence, n = None, np.array(capacity.bounds, np.int64), opened, past - number
            # More of the same length only make it tighter, so it stays the best until it is full.
            each = int((remains // demand).min())
            full = min(n, (past - number) // each)
            place = int(capacity.tokens - remains[0])
            filled = []
            if full:
                filled.append((full, each))
            elif n:
                filled.append((1, past - number))
            used = 0
            for sequences, copies in filled:
                out.append((length, number, number + sequences * copies, copies, sequence + used, place))
                number += sequences * copies
                left = np.vstack([left, remains - demand * copies])
                where = np.vstack([where, [sequence + used, sequences]])
                used += sequences
            if best is None:
                opened += used
            elif used < n:
                where[best] = sequence + used, n - used
            else:
                where[best] = 0, 0
            open_still = (where[:, 1] > 0) & (left[:, :2] > 0).all(axis=1) & (left[:, 2] > 0)
            left, where = left[open_still], where[open_still]
    return out


def _encode(path: str, longest: int):
    names = [x.split()[0] for x in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, END_ID)
        part, seen = TaskContext.get().partitionId(), np.zeros(longest + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids, counts = encoder.encode_all(as_bytes(batch.column("text")))
                pieces = -(-counts // longest)
                of = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * longest
                length = np.minimum(longest, counts[of] - start)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty(len(of), np.int64)
                nth[order] = np.arange(len(of)) - np.searchsorted(ordered, ordered)
                nth += seen[length]
                seen += np.bincount(length, minlength=longest + 1)
                wide = ids.astype("<u4")
                raw, stops = memoryview(wide).cast("B"), np.cumsum(length) * 4
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip((stops - length * 4).tolist(), stops.tolist(), strict=True)]
                columns = [
                    pa.array(np.full(len(of), part, np.int32)), pa.array(nth), batch.column("doc_id").take(pa.array(of)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)),
                    pa.array(crcs, pa.int64()), ids_column(wide, length),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return tidy(run)


def packed(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece, with its ids (`ids`, little-endian, 32 bits each) and its place (`sequence_id`, `offset`)."""
    spark = docs.sparkSession
    out = work_dir(spark, "pieces")
    rows = picked(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    encoded = rows.mapInArrow(_encode(path or tokenizer_path(), capacity.longest_piece), _PIECES)
    encoded.write.option("compression", "zstd").parquet(out)
    pieces = spark.read.schema(_PIECES).parquet(out)
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # One row a length, at most as many as a sequence has tokens.
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # The steps follow from the counts by length alone; their number does not grow with the documents.
    plan = F.broadcast(spark.createDataFrame(steps(totals, capacity), _STEPS))
    number = F.col("base") + F.col("nth")
    at = number - F.col("first")
    return (
        # Its rows grow with the tasks, so it is never broadcast.
        pieces.join(bases.hint("merge"), ["part", "length"])
        .join(plan, "length")
        .where((number >= F.col("first")) & (number < F.col("past")))
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("length").cast("long").alias("length"),
            "ids_crc32",
            (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
            (F.col("place") + at % F.col("each") * F.col("length")).alias("offset"),
            "ids",
        )
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its pieces in order and all their ids. A sequence's tokens bound what is gathered."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    gathered = pieces.groupBy("sequence_id").agg(inside.alias("pieces"))
    return gathered.select(
        "sequence_id",
        F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"),
        F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["ids"])), "")).alias("ids"),
    )
