"""Approximate neighbours: locality-sensitive buckets joined by bucket, ranked exactly.

Random hyperplanes cut the space; the sides a vector lies on give its bucket in
each of several tables. Queries and corpus rows of a bucket meet as dense blocks
and the k best of each query leave, so candidate pairs are never rows. Vectors
that lie close together share some bucket; what they share decides recall.

How many planes and tables that takes depends on how close the neighbours are.
`fit` finds out on a bounded sample: the exact neighbours inside the sample are
farther away than those in the whole corpus, so the recall reached there is
reached by the corpus as well. Every row of the corpus is in the index.

Buckets with many rows are dealt into blocks on both sides, so a bucket that
holds a third of the corpus still meets in groups of bounded size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tidewright.operators.neighbors import _ranked, _unit_rows, meet_in_cells
from tidewright.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 4000
SAMPLE_QUERIES = 500
TARGET_RECALL = 0.97
_BITS = (20, 16, 14, 12, 10, 9, 8, 7, 6, 5, 4, 3, 2)
_TABLES = (4, 8, 16, 32, 48)
# A table costs a copy of the corpus in the shuffle, counted as reading this share of it.
_TABLE_COST = 0.005
_CELL = ["table", "bucket", "query_block", "corpus_block"]


@dataclass(frozen=True)
class NeighborIndex:
    """Planes of a fitted index: `tables` times `bits` hyperplanes through `centre`."""

    planes: np.ndarray
    centre: np.ndarray
    bits: int
    tables: int
    sample_recall: float

    def codes(self, units: np.ndarray) -> np.ndarray:
        """Bucket of every row in every table; without planes all rows share one."""
        if not self.bits:
            return np.zeros((len(units), self.tables), np.int64)
        sides = (units - self.centre) @ self.planes > 0
        return sides.reshape(len(units), self.tables, self.bits) @ (1 << np.arange(self.bits))

    def bucketed(self, rows: DataFrame, key: str) -> DataFrame:
        """A row per table: table, bucket, key, embedding."""
        schema = T.StructType(
            [rows.schema[key], rows.schema["embedding"], T.StructField("codes", T.ArrayType(T.IntegerType()))]
        )

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    found = self.codes(_unit_rows(batch["embedding"])).astype(np.int32)
                    yield batch.assign(codes=list(found))

        coded = rows.select(key, "embedding").mapInPandas(cut, schema)
        return coded.select(F.posexplode("codes").alias("table", "bucket"), key, "embedding")

    def nearest(
        self, queries: DataFrame, corpus: DataFrame, k: int = 5, block_queries: int = 4096, block_rows: int = 16384
    ) -> DataFrame:
        """As `neighbors.nearest`, from the rows that share a bucket with the query."""
        # One row per table and bucket that both sides have, with the number of blocks on each side.
        asked = self.bucketed(written(queries.select("query_id", "embedding"), "queries"), "query_id")
        held = self.bucketed(corpus, "case_id")

        def dealt(rows: DataFrame, limit: int, name: str) -> DataFrame:
            blocks = F.when(F.col("n") <= limit, 1).otherwise(F.ceil(F.col("n") * 1.25 / limit)).cast("int")
            return rows.groupBy("table", "bucket").agg(F.count("*").alias("n")).select("table", "bucket", blocks.alias(name))

        cells = written(
            dealt(asked, block_queries, "query_blocks").join(dealt(held, block_rows, "corpus_blocks"), ["table", "bucket"]),
            "buckets",
        )

        def spread(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
            number = F.pmod(F.xxhash64(key, "table"), F.col(f"{own}s")).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
            return rows.join(cells, ["table", "bucket"]).withColumn(own, number).withColumn(other, every)

        left = spread(asked, "query_id", "query_block", "corpus_block")
        right = spread(held, "case_id", "corpus_block", "query_block")
        found = meet_in_cells(left, right, _CELL, k)
        # The same pair may meet in several tables, always with the same similarity.
        return written(_ranked(found.dropDuplicates(["query_id", "case_id"]), k), "neighbors")


def _sample_recall(codes: np.ndarray, true: np.ndarray) -> tuple[float, float]:
    """(share of true neighbours in a shared bucket, share of all rows in one) for the first rows of a sample."""
    met = np.zeros((len(true), len(codes)), bool)
    for table in range(codes.shape[1]):
        met |= codes[: len(true), table, None] == codes[None, :, table]
    return float(np.take_along_axis(met, true, axis=1).mean()), float(met.mean())


def fit(
    corpus: DataFrame,
    k: int = 5,
    target: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    sample_queries: int = SAMPLE_QUERIES,
    seed: int = 7,
) -> NeighborIndex:
    """Planes and tables that reach the recall on a sample of at most `sample_rows` rows, at the lowest cost.

    The sample's rows are those with the least hash of their id, so a rerun takes
    the same; the first `sample_queries` of them are searched for. If nothing
    reaches the recall, one bucket holds everything and the search is exact.
    """
    drawn = corpus.select("case_id", "embedding").where("embedding IS NOT NULL")
    held = drawn.orderBy(F.xxhash64(F.lit(seed), "case_id"), "case_id").limit(sample_rows).collect()
    units = _unit_rows([r["embedding"] for r in held]) if held else np.zeros((0, 1))
    dim = units.shape[1]
    centre = units.mean(axis=0) if held else np.zeros(dim)
    best, least = NeighborIndex(np.zeros((dim, 0)), centre, 0, 1, 1.0), 1.0
    k = min(k, len(held) - 1)
    if k < 1:
        return best
    scores = units[:sample_queries] @ units.T
    np.fill_diagonal(scores, -2.0)
    true = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    most = np.random.default_rng(seed).normal(size=(dim, max(_TABLES), max(_BITS)))
    for tables in _TABLES:
        for bits in _BITS:
            planes = most[:, :tables, :bits].reshape(dim, -1)
            index = NeighborIndex(planes, centre, bits, tables, 0.0)
            recall, read = _sample_recall(index.codes(units), true)
            if recall >= target:
                # Fewer bits only read more.
                if read + tables * _TABLE_COST < least:
                    best, least = NeighborIndex(planes, centre, bits, tables, recall), read + tables * _TABLE_COST
                break
    return best
