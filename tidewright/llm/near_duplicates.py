"""Near duplicates of whole texts by bottom-k sketches of one hash function.

1. Every text becomes its set of distinct shingle hashes; texts of equal sets
   form a class, of which one member goes on.
2. A sketch is the `K` smallest hashes of a set. Runs of three consecutive
   retained values are the terms of inverted lists: two sets at the threshold
   share each value of their common sketch with at least that chance, and so many
   first values are taken (53 at 0.80, 41 at 0.85) that all runs miss with a
   chance of at most 1e-8; sets of up to so many values can't miss. Sets so short
   that a link can part every run of three (4 and 5 values at 0.80, none at 0.85)
   get their runs of two as well.
3. In every list each set is paired with the one before it in order of size and
   with the list's first set of a size in reach. Pairs whose union sketch
   estimates enough get one label; the least estimate comes from the threshold
   (34 of 64 values at 0.80, 39 at 0.85) so that it drops a link with a chance of
   at most 1e-6. Lists that still hold several labels are compared
   as a whole, with the same estimate.
4. So every pair that can be a link is inside one label. There the full sets are
   compared exactly, and what is linked becomes one component.

Comparisons of whole lists and labels run in pairs of blocks of bounded size;
of each, only the edges that join what was not joined yet go on, so groups of
near copies never emit all their pairs, and no link between different texts is
lost. Nothing is collected to the driver.

The threshold is 0.8 unless given. Under 0.76 the `K` values of a sketch are too
few for these chances, and the threshold is refused.

Defined cases: null and empty texts have an empty set and are linked with
nothing; a document with fewer words than the shingle width has its whole
sequence as one shingle; rows without an id are never linked by `components`
(`without_near_duplicates` links them and keeps one row of a group); rows that
repeat an id have the component of their own text, so an id with two texts may
stand in two; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import as_bytes, folded_space_words, picked, slices, small_or_shuffled, tidy
from tidewright.llm.shingles import mix, shingle_sets
from tidewright.session import written

WIDTH = 5
PERCENT = 80
K = 64
RUN = 3
LIST_MISS, ESTIMATE_MISS = 1e-8, 1e-6
PART = 10_000
BLOCK = 2048
SET_BLOCK = 1024

SIGNATURES = "doc_id long, text_hash long, n_shingles long, set_key binary, sketch binary"
TERMS = "term long, node long, n long"


def term_values(percent: int) -> int:
    """How many sketch values make terms: the fewest whose runs all miss with a chance of at most `LIST_MISS`."""
    p = percent / 100
    # Chances that no run is complete yet, by the number of shared values at the end.
    open_ = [1.0] + [0.0] * (RUN - 1)
    for n in range(1, K + 1):
        open_ = [(1 - p) * sum(open_), *(p * x for x in open_[:-1])]
        if sum(open_) <= LIST_MISS:
            return n
    raise ValueError(f"sketches of {K} values are too short for a threshold of {percent} percent")


def short_values(percent: int) -> int:
    """Largest set in which the `d` unshared values of a link can part every run of three: 2 (d + 1) shared ones at most."""
    gaps = 2 * (100 - percent) // (3 * percent - 200)
    return 3 * gaps + 2 if gaps else 0


def least_estimate(percent: int) -> float:
    """The estimate that a pair at the threshold falls short of with a chance of at most `ESTIMATE_MISS`."""
    p, count, below = percent / 100, 0, (1 - percent / 100) ** K
    while count < K and below <= ESTIMATE_MISS:
        count += 1
        below += comb(K, count) * p**count * (1 - p) ** (K - count)
    return count / K


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets([folded_space_words(t) for t in as_bytes(batch.column("text"))], width)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array([s[:K].tobytes() for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_key", "sketch"],
                )

    return tidy(run)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets([folded_space_words(t) for t in as_bytes(batch.column("text"))], width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "held"]
                )

    return tidy(run)


def _runs_of(values: np.ndarray, run: int) -> np.ndarray:
    """Hash of every `run` consecutive values."""
    n = max(0, len(values) - run + 1)
    term = values[:n]
    for k in range(1, run):
        term = mix(term + values[k : k + n])
    return term


def _terms(percent: int):
    most, short = term_values(percent), short_values(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = batch.column("node").to_numpy(), batch.column("n").to_numpy()
            found = []
            for sketch in batch.column("sketch").to_pylist():
                values = np.frombuffer(sketch, np.uint64)[:most]
                terms = _runs_of(values, RUN)
                if len(values) <= short:
                    terms = np.concatenate((terms, _runs_of(values, RUN - 1)))
                found.append(terms)
            counts = np.array([len(t) for t in found], np.int64)
            terms = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms), pa.array(np.repeat(nodes, counts)), pa.array(np.repeat(sizes, counts))],
                names=["term", "node", "n"],
            )

    return run


def _neighbours(percent: int):
    """Rows come ordered by (term, part, n, node); every row names at most two earlier ones of its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, last = None, None, None
        for batch in batches:
            left, right = [], []
            for term, part, n, node in zip(
                *[batch.column(c).to_pylist() for c in ("term", "part", "n", "node")], strict=True
            ):
                if key != (term, part):
                    key, first, last = (term, part), (n, node), (n, node)
                    continue
                if last[1] != node and 100 * last[0] >= percent * n:
                    left.append(last[1])
                    right.append(node)
                if 100 * first[0] < percent * n:
                    first = (n, node)
                elif first[1] not in (node, last[1]):
                    left.append(first[1])
                    right.append(node)
                last = (n, node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return tidy(run)


def _estimated(least: float):
    """Keeps the pairs whose union sketch estimates at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True):
                kept.append(union_estimate(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return tidy(run)


def union_estimate(x: np.ndarray, y: np.ndarray) -> float:
    """Share of the K smallest values of the union that both sketches hold."""
    both = np.concatenate((x, y))
    both.sort()
    twice = both[1:] == both[:-1]
    first = np.ones(len(both), bool)
    first[1:] = ~twice
    union = both[first][:K]
    shared = both[1:][twice]
    return np.count_nonzero(shared <= union[-1]) / len(union) if len(union) else 0.0


class _Forest:
    """Joins labels; hands on only the edges that join two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _counted(own: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as a matrix product over the first list's values."""
    names, inverse = np.unique(np.concatenate(own), return_inverse=True)
    x = np.zeros((len(own), len(names)), np.float32)
    x[np.repeat(np.arange(len(own)), [len(s) for s in own]), inverse] = 1
    values = np.concatenate(other)
    at = np.minimum(np.searchsorted(names, values), len(names) - 1)
    known = names[at] == values
    y = np.zeros((len(other), len(names)), np.float32)
    y[np.repeat(np.arange(len(other)), [len(s) for s in other])[known], at[known]] = 1
    return x @ y.T


def _runs(where: np.ndarray, sets: list[np.ndarray], values: int, most: int):
    """Parts of `where` with about `values` set values and at most `most` sets."""
    start = held = 0
    for k, w in enumerate(where):
        if k > start and (held + len(sets[w]) > values or k - start >= most):
            yield where[start:k]
            start, held = k, 0
        held += len(sets[w])
    if start < len(where):
        yield where[start:]


def _estimates(own: list[np.ndarray], other: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """Resemblance by the values up to the lesser of both sketches' ends, all of which both sketches would hold."""

    def end(s: np.ndarray) -> int:
        return int(s[-1]) if len(s) >= K else (1 << 32) - 1

    ends = np.array([end(s) for s in own], np.uint64), np.array([end(s) for s in other], np.uint64)
    least = np.minimum(ends[0][:, None], ends[1][None, :])
    a = np.stack([np.searchsorted(s, row, side="right") for s, row in zip(own, least, strict=True)])
    b = np.stack([np.searchsorted(s, column, side="right") for s, column in zip(other, least.T, strict=True)]).T
    return shared / np.maximum(1, a + b - shared)


def _compare(percent: int, exact: bool):
    """Rows come ordered by (term, i, j); a group is two blocks of one list (or one block with itself).

    Resembling sets of different labels are joined, by the estimate from short
    sketches or exactly from full sets; only edges that join two labels which no
    earlier edge of the group has joined are handed on, so their number stays
    under that of the rows.
    """
    kind = np.uint64 if exact else np.dtype("<u4")
    values = 30_000 if exact else 1 << 14
    least = least_estimate(percent)

    def edges(rows) -> list[tuple[int, int]]:
        nodes = np.array([r[0] for r in rows])
        sizes = np.array([r[1] for r in rows])
        labels = np.array([r[2] for r in rows])
        side = np.array([r[3] for r in rows])
        sets = [np.frombuffer(r[4], kind) for r in rows]
        i, j = rows[0][5:7]
        forest, found = _Forest(), []
        for own in _runs(np.flatnonzero(side == i), sets, values, 256):
            for other in _runs(np.flatnonzero(side == j), sets, 1 << 20, 256):
                open_ = labels[own][:, None] != labels[other][None, :]
                low = np.minimum(sizes[own][:, None], sizes[other][None, :])
                high = np.maximum(sizes[own][:, None], sizes[other][None, :])
                open_ &= 100 * low >= percent * high
                if i == j:
                    open_ &= own[:, None] < other[None, :]
                if not open_.any():
                    continue
                x, y = [sets[k] for k in own], [sets[k] for k in other]
                shared = _counted(x, y)
                if exact:
                    whole = shared.astype(np.int64)
                    open_ &= 100 * whole >= percent * (sizes[own][:, None] + sizes[other][None, :] - whole)
                else:
                    open_ &= _estimates(x, y, shared) >= least
                p, q = np.nonzero(open_)
                for a, b in zip(own[p].tolist(), other[q].tolist(), strict=True):
                    if forest.join(int(labels[a]), int(labels[b])):
                        found.append((int(nodes[a]), int(nodes[b])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs):
            return pa.RecordBatch.from_arrays(
                [pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())],
                names=["a", "b"],
            )

        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("term", "node", "n", "label", "block", "held", "i", "j")]
            for row in zip(*columns, strict=True):
                if key != (row[0], row[6], row[7]):
                    if len(held) > 1 and (pairs := edges(held)):
                        yield out(pairs)
                    key, held = (row[0], row[6], row[7]), []
                held.append(row[1:])
        if len(held) > 1 and (pairs := edges(held)):
            yield out(pairs)

    return tidy(run)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The upper halves of the sketch values, in their order."""
    for batch in batches:
        short = [(np.frombuffer(s, np.uint64) >> np.uint64(32)).astype("<u4").tobytes() for s in batch.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(short, pa.binary())], names=["node", "held"])


def _in_blocks(rows: DataFrame, size: int, compare) -> DataFrame:
    """Compares all members of every list (term, length) in pairs of blocks of about `size` members."""
    blocks = F.ceil(F.col("length") / size)
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select(
            "term", "node", "n", "label", "block", "held",
            F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        )
        .repartition("term", "i", "j")
        .sortWithinPartitions("term", "i", "j")
        .mapInArrow(compare, "a long, b long")
    )


def connected(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) with the smallest node reachable, for every node of the links (a, b).

    Labels fall to the least neighbour's and then to their label's label, so the
    number of rounds grows with the logarithm of a component's width. Each round
    is stored.
    """
    spark = links.sparkSession
    both = written(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .distinct(),
        f"{purpose}-links",
    )
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("component")), purpose)
    while True:
        near = (
            both.join(labels, both.v == labels.node)
            .groupBy("u")
            .agg(F.min("component").alias("near"))
        )
        fallen = labels.join(near, labels.node == near.u, "left").select(
            "node", "component", F.least("component", F.coalesce("near", "component")).alias("low")
        )
        own = labels.select(F.col("node").alias("of"), F.col("component").alias("up"))
        moved = written(
            fallen.join(own, fallen.low == own.of, "left").select(
                "node",
                F.least("low", F.coalesce("up", "low")).alias("component"),
                (F.least("low", F.coalesce("up", "low")) < F.col("component")).alias("changed"),
            ),
            purpose,
        )
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose union sketch estimates enough."""
    sketches = nodes.select("node", "sketch")
    both = pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b")
    return both.mapInArrow(_estimated(least_estimate(percent)), "a long, b long")


def _row_key(doc_id: str = "doc_id") -> Column:
    """Order of rows: by id, rows without one last, then by hash of the text."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), F.col("text_hash").alias("text_hash"))


def _classes(rows: DataFrame, width: int, percent: int, without_id: bool) -> tuple[DataFrame, DataFrame]:
    """(signatures of all rows; set_key, component and its smallest id of every set).

    `rows` has doc_id, text and text_hash. A class of equal sets is a node of its
    own number, so that an id with several texts stands in several classes.
    """
    signatures = written(rows.mapInArrow(_signatures(width), SIGNATURES), "signatures")
    named = signatures.where("set_key is not null")
    if not without_id:
        named = named.where("doc_id is not null")
    nodes = written(
        named.groupBy("set_key")
        .agg(F.min(_row_key()).alias("row"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", "row.doc_id", "row.text_hash", "n", "sketch"),
        "sketches",
    )
    terms = nodes.select("node", "n", "sketch").mapInArrow(_terms(percent), TERMS)
    longer = terms.groupBy("term").agg(F.count("*").alias("length")).where("length > 1")
    lists = written(terms.join(longer, "term"), "inverted-lists")

    # Pairs along the lists, by estimate: most of what resembles gets one label.
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("length") / PART))
    along = (
        lists.select("term", part.alias("part"), "n", "node")
        .repartition("term", "part")
        .sortWithinPartitions("term", "part", "n", "node")
        .mapInArrow(_neighbours(percent), "a long, b long")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    labels = connected(_likely(along, nodes, percent), "labels")

    # Lists with several labels are compared as a whole, also by estimate.
    labelled = lists.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    mixed = labelled.groupBy("term").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_terms = mixed.where("low < high").select("term")
    marks = nodes.select("node", "sketch").mapInArrow(_marks, "node long, held binary")
    across = _in_blocks(
        labelled.join(open_terms, "term", "left_semi").join(marks, "node"), BLOCK, _compare(percent, False)
    )
    joined = labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    clusters = connected(across.unionByName(joined), "clusters")

    # Every likely pair is inside a cluster; there, full sets decide. A row's id and
    # text hash lead back to its text.
    wanted = written(
        nodes.join(clusters.select("node"), "node", "left_semi").select(
            "node", F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")
        ),
        "wanted",
    )
    found = rows.join(small_or_shuffled(wanted), (F.col("text_hash") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
    sets = found.select("node", "text").mapInArrow(_sets(width), "node long, held binary").dropDuplicates(["node"])
    lengths = clusters.groupBy("component").agg(F.count("*").alias("length"))
    gathered = (
        sets.join(clusters.join(lengths, "component"), "node")
        .select(
            F.col("component").alias("term"), "node", F.col("node").alias("label"), "held", "length",
            (F.octet_length("held") / 8).cast("long").alias("n"),
        )
    )
    final = connected(_in_blocks(gathered, SET_BLOCK, _compare(percent, True)), "components")
    ids = nodes.select("set_key", "node", "doc_id")
    lowest = ids.join(final, "node").groupBy("component").agg(F.min("doc_id").alias("low"))
    classes = ids.join(final.join(lowest, "component"), "node", "left").select(
        F.col("set_key").alias("of_key"),
        F.coalesce("component", "node").alias("component"),
        F.coalesce("low", "doc_id").alias("low"),
    )
    return signatures, classes


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = picked(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.withColumn("text_hash", F.xxhash64("text"))


def components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    signatures, classes = _classes(_keyed(docs, id_col, text_col), width, percent, False)
    joined = signatures.select("doc_id", "n_shingles", "set_key").join(
        classes, (F.col("set_key") == F.col("of_key")) & F.col("doc_id").isNotNull(), "left"
    )
    component: Column = F.coalesce("low", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One document of each component with its own columns; documents with an empty set all stay.

    Here rows without an id are linked like others. The row with the smallest id
    stays, then that with the smallest hash of its text (rows without an id come
    last); of rows that are equal in both, one.
    """
    signatures, classes = _classes(_keyed(docs, id_col, text_col), width, percent, True)
    pairs = (
        signatures.where("set_key is not null")
        .groupBy("doc_id", "text_hash")
        .agg(F.first("set_key").alias("set_key"), F.count("*").alias("rows"))
        .join(classes.select("of_key", "component"), F.col("set_key") == F.col("of_key"))
    )
    chosen = pairs.groupBy("component").agg(F.min(_row_key()).alias("best"))
    stays = F.col("best") == _row_key()
    marked = written(
        pairs.join(chosen, "component")
        .where(~stays | (F.col("rows") > 1))
        .select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), stays.alias("stays")),
        "near-marks",
    )
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = {name: f"c{i}" for i, name in reversed(list(enumerate(docs.columns)))}
    rows = docs.toDF(*own).withColumns(
        {"key_id": F.col(at[id_col]).cast("long"), "key_hash": F.xxhash64(F.col(at[text_col]).cast("string"))}
    )
    same = (F.col("key_hash") == F.col("of_hash")) & F.col("key_id").eqNullSafe(F.col("of_id"))
    single = rows.join(small_or_shuffled(marked), same, "left_anti")
    repeated = rows.join(small_or_shuffled(marked.where("stays")), same, "left_semi")
    # Planned as a group limit before the shuffle: a task hands on one row of a pair.
    first = F.row_number().over(Window.partitionBy("key_id", "key_hash").orderBy("key_hash"))
    one = repeated.withColumn("place", first).where("place = 1")
    return single.select(*own).unionByName(one.select(*own)).toDF(*docs.columns)
