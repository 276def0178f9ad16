"""Exact cosine top-k for many queries at once.

The query side is stored once and measured. If it fits one block of bounded size
it goes to the executors, which read the corpus in place, without a shuffle.
Otherwise both sides are dealt into blocks, and every block of queries meets
every block of the corpus as a group of its own: one job, however many blocks.
Either way only the k best rows of each query and task or group leave it.

Similarities are compared after rounding to nine decimals, finer than the
float vectors themselves; equal ones are ordered by id.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.functions.bands import similarity_band
from tidewright.operators.ranking import top_k
from tidewright.operators.skew import skew_safe_lookup
from tidewright.session import written

# The task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Query side that is sent to every executor at once.
MAX_BLOCK_BYTES = 16 * 1024 * 1024
MAX_BLOCK_QUERIES = 4096
# Corpus rows that meet a block of queries in one task.
MAX_BLOCK_ROWS = 65536
# Rows of the two sides whose similarities are in memory at a time.
_ROWS_AT_ONCE = 1024
_QUERIES_AT_ONCE = 1024
# More close rows than so many times k a query are not looked at one by one.
_MANY = 8
# Blocks a side is dealt into as finely as asked for; beyond them only as many as memory needs.
MAX_FINE_BLOCKS = 16
_DECIMALS = 9


def _unit_rows(vectors: pd.Series | list) -> np.ndarray:
    lengths = {None if v is None else len(v) for v in vectors}
    if len(lengths) > 1 or None in lengths:
        raise ValueError(f"vectors must be present and of one length, found lengths {lengths}")
    matrix = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    length[length == 0.0] = 1.0
    return matrix / length


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best scores of every row; equal scores prefer the lower column."""
    if scores.shape[1] > k:
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]]
        row, column = np.nonzero(scores >= floor)
    else:
        row, column = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    start = np.searchsorted(row, np.arange(scores.shape[0]))
    kept = np.arange(len(row)) - start[row] < k
    return row[kept], column[kept]


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the true cells in order, for a mask with few of them.

    Eight cells are looked at as one number, so the many false ones cost little.
    """
    cells = np.ascontiguousarray(mask).ravel()
    whole = len(cells) // 8 * 8
    words = np.flatnonzero(cells[:whole].view(np.uint64))
    near = (words[:, None] * 8 + np.arange(8)).ravel()
    flat = np.concatenate([near[cells[near]], whole + np.flatnonzero(cells[whole:])])
    return np.divmod(flat, max(1, mask.shape[1]))


class _Block:
    """Queries of one task, and the k best of the corpus rows they have met so far.

    Once a query has k rows, single precision tells which of the next ones can
    still be among its best; its error stays below `margin`, as all vectors are
    of unit length. Only those are computed in full.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rough = vectors.astype(np.float32)
        self.margin = 1.2e-7 * (vectors.shape[1] + 8) + 10.0**-_DECIMALS
        self.bar = np.full((len(ids), 1), -np.inf, dtype=np.float32)
        self.parts: list[pd.DataFrame] = []
        self.waiting = 0

    def meet(self, held: pd.DataFrame) -> None:
        held = held.sort_values("case_id")
        for at in range(0, len(held), _ROWS_AT_ONCE):
            part = held.iloc[at : at + _ROWS_AT_ONCE]
            rows, case_ids = _unit_rows(part["embedding"]), part["case_id"].to_numpy()
            if rows.shape[1] != self.vectors.shape[1]:
                raise ValueError(f"queries have {self.vectors.shape[1]} dimensions, the corpus {rows.shape[1]}")
            rough = rows.astype(np.float32)
            for first in range(0, len(self.ids), _QUERIES_AT_ONCE):
                self._meet(slice(first, first + _QUERIES_AT_ONCE), rows, rough, case_ids)
            if self.waiting > len(self.ids) * self.k:
                self._merge()

    def _meet(self, asked: slice, rows: np.ndarray, rough: np.ndarray, case_ids: np.ndarray) -> None:
        bar, vectors = self.bar[asked], self.vectors[asked]
        if np.isneginf(bar).any():
            close = None
        else:
            close = _places(self.rough[asked] @ rough.T >= bar)
        if close is None or len(close[0]) > _MANY * self.k * len(vectors):
            # Nothing to compare with yet, or crowds of equal rows.
            scores = np.round(vectors @ rows.T, _DECIMALS)
            who, which = _best(scores, self.k)
            similarity = scores[who, which]
        else:
            who, which = close
            similarity = np.round(np.einsum("ij,ij->i", vectors[who], rows[which]), _DECIMALS)
        if len(who):
            found = {"who": who + asked.start, "case_id": case_ids[which], "similarity": similarity}
            self.parts.append(pd.DataFrame(found))
            self.waiting += len(who)
        if close is None and len(rows) >= self.k:
            self._merge()

    def _merge(self) -> None:
        if self.waiting:
            ordered = pd.concat(self.parts).sort_values(["who", "similarity", "case_id"], ascending=[True, False, True])
            best = ordered.groupby("who", sort=False).head(self.k)
            self.parts, self.waiting = [best], 0
            who = best["who"].to_numpy()
            last = np.nonzero(np.bincount(who, minlength=len(self.ids)) == self.k)[0]
            ends = np.searchsorted(who, last, side="right") - 1
            self.bar[last, 0] = best["similarity"].to_numpy()[ends] - self.margin

    def best(self) -> pd.DataFrame:
        self._merge()
        if not self.parts:
            return pd.DataFrame({"query_id": [], "case_id": [], "similarity": []})
        found = self.parts[0]
        return pd.DataFrame(
            {
                "query_id": self.ids[found["who"].to_numpy()],
                "case_id": found["case_id"].to_numpy(),
                "similarity": found["similarity"].to_numpy(),
            }
        )


def _result_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("case_id", corpus.schema["case_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    return top_k(candidates, "query_id", k, F.desc("similarity"), "case_id")


def _scan(block: list, queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """One pass over the corpus for one block of queries, best k per query and task."""
    query_ids = np.array([r["query_id"] for r in block], dtype=object)
    matrix = _unit_rows([r["embedding"] for r in block])
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = _Block(*shared.value, k)
        for batch in batches:
            block.meet(batch)
        found = block.best()
        if len(found):
            yield found

    return corpus.select("case_id", "embedding").mapInPandas(scan, _result_schema(queries, corpus))


def _meet(k: int):
    """The k best rows of one block of the corpus for each query of one block."""

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"query_id": [], "case_id": [], "similarity": []})
        block = _Block(asked["query_id"].to_numpy(), _unit_rows(asked["embedding"]), k)
        block.meet(held)
        return block.best()

    return meet


def meet_in_cells(asked: DataFrame, held: DataFrame, cell: list[str], k: int) -> DataFrame:
    """Best k rows per query of every cell in which both sides have rows."""
    left = asked.select(*cell, "query_id", "embedding").groupBy(*cell)
    right = held.select(*cell, "case_id", "embedding").groupBy(*cell)
    return left.cogroup(right).applyInPandas(_meet(k), _result_schema(asked, held))


def blocks_of(n: int, limit: int) -> int:
    """Blocks for n rows dealt out by hash; a quarter of room keeps them under the limit."""
    return 1 if n <= limit else -(-5 * n // (4 * limit))


def dealt_blocks(n: int, limit: int, fitting: int) -> int:
    """Blocks of a side in a join of all with all.

    A row is copied for every block of the other side, so small blocks multiply
    what is shuffled by the size of the input. Their number therefore stops at
    `MAX_FINE_BLOCKS`, until blocks of that number outgrow the `fitting` rows.
    """
    return min(blocks_of(n, min(limit, fitting)), max(MAX_FINE_BLOCKS, blocks_of(n, fitting)))


def _block_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def block_join(queries: DataFrame, corpus: DataFrame, k: int, query_blocks: int, corpus_blocks: int) -> DataFrame:
    """Every block of queries against every block of the corpus, merged by rank.

    A row travels once for each block of the other side, so `query_blocks` copies
    of the corpus and `corpus_blocks` copies of the queries are shuffled.
    """
    asked = queries.withColumn("query_block", _block_of("query_id", query_blocks)).withColumn(
        "corpus_block", _every(corpus_blocks)
    )
    held = corpus.withColumn("corpus_block", _block_of("case_id", corpus_blocks)).withColumn(
        "query_block", _every(query_blocks)
    )
    return _ranked(meet_in_cells(asked, held, ["query_block", "corpus_block"], k), k)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    block_queries: int = MAX_BLOCK_QUERIES,
    block_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Top-k corpus rows per query: query_id, case_id, similarity, rank.

    `queries` has query_id and embedding, `corpus` case_id and embedding. The
    query side is computed once and stored; the search runs here and the stored
    result is returned, as it is usually read more than once. Vectors that are
    missing or differ in length are an error.
    """
    slim = written(queries.select("query_id", "embedding"), "queries")
    size = slim.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    if not size["n"]:
        return _ranked(corpus.sparkSession.createDataFrame([], _result_schema(queries, corpus)), k)
    fitting = max(1, MAX_BLOCK_BYTES // (8 * max(1, size["dim"] or 1)))
    query_blocks = dealt_blocks(size["n"], block_queries, fitting)
    if query_blocks == 1:
        found = _ranked(_scan(slim.collect(), queries, corpus, k), k)
    else:
        corpus_blocks = dealt_blocks(corpus.count(), block_rows, fitting)
        found = block_join(slim, corpus, k, query_blocks, corpus_blocks)
    return written(found, "neighbors")


def with_band(matches: DataFrame) -> DataFrame:
    return matches.withColumn("similarity_band", similarity_band(F.col("similarity")))


def search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    find: Callable[[DataFrame, DataFrame, int], DataFrame] = nearest,
) -> DataFrame:
    """Top-k with the metadata of the matched case and the similarity band.

    Many queries may match the same case, so the look-up is skew-safe. `find`
    may be a fitted index's `nearest` for an approximate search.
    """
    found = with_band(find(queries, corpus, k))
    return skew_safe_lookup(found, corpus.drop("embedding"), "case_id")
