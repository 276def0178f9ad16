"""A trie of rebuilt conversations without rebuilding any text.

A rebuilt conversation is the first turns of a base conversation followed by
what the own conversation has after its head. Its prefixes are named by a
monoid of (length, hash): the hash of a sequence is the sum of its turns'
digests times rising powers of a base, modulo a prime, in four lanes; joining
two sequences shifts the second one's hash by the first one's length. So every
original conversation is hashed once, from its own turns, and the hash of a
rebuilt prefix follows from three of those values: base head, own head, own
prefix. Texts are read once and leave the first stage as SHA-256 digests and
byte counts.

1. Turns are sorted by range over (conversation, turn, digest, row), so that one
   long conversation spreads over many tasks. Each task hashes prefixes within
   its range; conversations that cross a border, at most two for each range, are
   joined up by composing the ranges' products.
2. A rebuilt prefix is a member of the node of its depth and hash. A group's
   members must agree in the hash of the prefix before and in the half of the
   last turn's digest that the hash does not use; with the same holding one
   level up, equal names mean equal sequences. If any group fails, all is done
   again with other bases.
3. The smallest conversation of a node stands for it. A conversation stands for
   its own prefixes from some depth on, so what lies below a node is what its
   other members stand for plus what its own stands for further down: sums over
   members, no walk from level to level.

Defined cases: null role or text is empty; turns are ordered by (turn, SHA-256
of the length of the role, role and text), null turns first, so repeated and
tied rows are all kept in a fixed order; rows without a conversation id belong
to none and are left out; a missing base gives no head; an empty table gives an
empty result; other columns are ignored. `%` is SQL's: the remainder has the
sign of the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import picked, tidy
from tidewright.session import written

PRIME = (1 << 31) - 1
LANES = 4
_MASK = (1 << 31) - 1
# Depths of a conversation that are summed in one window.
BLOCK = 4096

GROUP = 5
HEADS = 9

_SCANNED = "part int, conv_id long, at long, a long, b long, prev_a long, prev_b long, check_a long, check_b long, bytes long"
_NODE = ["depth", "a", "b"]


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def head_of(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("long")


def lane_bases(seed: int) -> list[int]:
    return [int(x) for x in np.random.default_rng(seed).integers(1 << 20, PRIME - 1, LANES)]


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo the prime for every exponent."""
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * np.uint64(square) % np.uint64(PRIME)
        square = square * square % PRIME
        left >>= np.uint64(1)
    return out


def _packed(lanes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a, b = (lanes[i] << np.uint64(31) | lanes[i + 1] for i in (0, 2))
    return a.astype(np.int64), b.astype(np.int64)


def _scan(bases: list[int]):
    """Hashes of prefixes within one sorted range; only the running values of the last conversation are held."""
    names = [x.split()[0] for x in _SCANNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, n, sums = None, 0, [0] * LANES
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            held = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(rows, 32)
            turns = np.ascontiguousarray(held[:, :16]).view("<u4").astype(np.uint64) % np.uint64(PRIME)
            checks = np.ascontiguousarray(held[:, 16:]).view("<i8")
            new = np.append(ids[0] != last, ids[1:] != ids[:-1])
            run_of = np.cumsum(new) - (1 if new[0] else 0)
            firsts = np.append([] if new[0] else [0], np.flatnonzero(new)).astype(np.int64)
            at = np.arange(rows) - firsts[run_of]
            if not new[0]:
                at[run_of == 0] += n
            after, before = [], []
            for lane, base in enumerate(bases):
                terms = turns[:, lane] * powers(base, at) % np.uint64(PRIME)
                total = np.append(np.uint64(0), np.cumsum(terms, dtype=np.uint64))
                start = total[firsts][run_of]
                carry = np.zeros(rows, np.uint64)
                if not new[0]:
                    carry[run_of == 0] = sums[lane]
                after.append((total[1:] - start + carry) % np.uint64(PRIME))
                before.append((total[:-1] - start + carry) % np.uint64(PRIME))
            last, n, sums = ids[-1], int(at[-1]) + 1, [int(x[-1]) for x in after]
            columns = [
                np.full(rows, part, np.int32), ids, at + 1, *_packed(after), *_packed(before),
                np.ascontiguousarray(checks[:, 0]), np.ascontiguousarray(checks[:, 1]),
            ]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column("bytes")], names=names)

    return tidy(run)


def _lanes(a: str | Column, b: str | Column) -> list[Column]:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return [F.shiftright(a, 31), a.bitwiseAND(F.lit(_MASK)), F.shiftright(b, 31), b.bitwiseAND(F.lit(_MASK))]


def _pack(lanes: list[Column]) -> tuple[Column, Column]:
    return F.shiftleft(lanes[0], 31) + lanes[1], F.shiftleft(lanes[2], 31) + lanes[3]


def _prefixes(turns: DataFrame, bases: list[int]) -> DataFrame:
    """conv_id, at (from 1), hash of the first `at` turns and of those before the last, per original turn."""
    spark = turns.sparkSession
    order = ["conv_id", "turn", "digest", "row"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *order)
    local = written(
        ranged.sortWithinPartitions(*order).select("conv_id", "digest", "bytes").mapInArrow(_scan(bases), _SCANNED),
        "prefix-hashes",
    )
    pieces = local.groupBy("conv_id", "part").agg(F.max("at").alias("n"), F.max_by(F.struct("a", "b"), "at").alias("s"))
    crossing = pieces.withColumn("parts", F.count("*").over(Window.partitionBy("conv_id"))).where("parts > 1")
    carried, held = [], {}
    # At most two rows for each range: only its first and its last conversation can cross a border.
    for row in sorted(crossing.collect(), key=lambda r: (r.conv_id, r.part)):
        length, sums = held.get(row.conv_id, (0, [0] * LANES))
        steps = [pow(base, length, PRIME) for base in bases]
        carried.append((row.conv_id, row.part, length, *sums, *steps))
        own = [row.s.a >> 31, row.s.a & _MASK, row.s.b >> 31, row.s.b & _MASK]
        held[row.conv_id] = length + row.n, [(s + p * x) % PRIME for s, p, x in zip(sums, steps, own, strict=True)]
    if not carried:
        return local.drop("part")
    kinds = ", ".join(f"{x}{i} long" for x in ("carry", "step") for i in range(LANES))
    carries = F.broadcast(spark.createDataFrame(carried, f"conv_id long, part int, before long, {kinds}"))
    joined = local.join(carries, ["conv_id", "part"], "left")
    whole = {"at": F.col("at") + F.coalesce("before", F.lit(0))}
    for a, b in (("a", "b"), ("prev_a", "prev_b")):
        lanes = [
            (F.coalesce(f"carry{i}", F.lit(0)) + F.coalesce(f"step{i}", F.lit(1)) * x) % PRIME
            for i, x in enumerate(_lanes(a, b))
        ]
        whole[a], whole[b] = _pack(lanes)
    return joined.select(*[whole.get(c, F.col(c)).alias(c) for c in local.columns if c != "part"])


def _members(prefixes: DataFrame, bases: list[int], base: Callable, head: Callable, most: int) -> DataFrame:
    """One row for every prefix of every rebuilt conversation: its node's name and that of the prefix before."""
    turn = ["at", "a", "b", "prev_a", "prev_b", "check_a", "check_b", "bytes"]
    # At most `most` turns are gathered for a conversation.
    kept = F.sort_array(F.collect_list(F.when(F.col("at") <= most, F.struct(*turn))))
    convs = written(prefixes.groupBy("conv_id").agg(F.max("at").alias("n"), kept.alias("head")), "conversations")
    named = convs.withColumns({"base": base(F.col("conv_id")), "take": head(F.col("conv_id"))})
    bases_of = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    found = named.join(bases_of, "base", "left").withColumn(
        "held", F.least("take", F.coalesce("base_n", F.lit(0)))
    )

    def hash_at(turns: str, count: str, field: str) -> Column:
        return F.when(F.col(count) > 0, F.get(turns, F.col(count).cast("int") - 1)[field]).otherwise(F.lit(0))

    plans = written(
        found.withColumn("own", F.least("take", "n")).select(
            "conv_id",
            "take",
            "held",
            (F.col("held") + F.greatest(F.lit(0), F.col("n") - F.col("take"))).alias("length"),
            *[hash_at("base_head", "held", x).alias(f"base_{x}") for x in "ab"],
            *[hash_at("head", "own", x).alias(f"own_{x}") for x in "ab"],
            F.when(F.col("held") > 0, F.slice("base_head", F.lit(1), F.col("held").cast("int"))).alias("turns"),
        ),
        "rebuilt",
    )
    # Moving the own part back by take - held turns divides its hash by that power.
    back = [[pow(pow(x, k, PRIME), -1, PRIME) for k in range(most + 1)] for x in bases]

    def rebuilt(a: str, b: str) -> tuple[Column, Column]:
        shift = (F.col("take") - F.col("held")).cast("int")
        lanes = zip(_lanes("base_a", "base_b"), _lanes(a, b), _lanes("own_a", "own_b"), back, strict=True)
        return _pack([
            (front + (x - own + PRIME) % PRIME * F.get(F.array(*map(F.lit, steps)), shift).cast("long")) % PRIME
            for front, x, own, steps in lanes
        ])

    after, before = rebuilt("a", "b"), rebuilt("prev_a", "prev_b")
    own = prefixes.join(plans.drop("turns"), "conv_id").where(F.col("at") > F.col("take")).select(
        "conv_id",
        "length",
        (F.col("held") + F.col("at") - F.col("take")).alias("depth"),
        after[0].alias("a"),
        after[1].alias("b"),
        before[0].alias("prev_a"),
        before[1].alias("prev_b"),
        "check_a",
        "check_b",
        "bytes",
    )
    heads = plans.select("conv_id", "length", F.explode("turns").alias("t")).select(
        "conv_id", "length", F.col("t.at").alias("depth"), *[F.col(f"t.{x}") for x in turn[1:]]
    )
    zero = F.lit(0).cast("long")
    roots = plans.select("conv_id", "length", zero.alias("depth"), *[zero.alias(x) for x in turn[1:]])
    rows = own.unionByName(heads).unionByName(roots)
    return written(rows.withColumn("ends", (F.col("depth") == F.col("length")).cast("long")).drop("length"), "members")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node; rows come in order and only a running digest is held."""
    held, running = None, None

    def out(rows):
        columns = [*zip(*rows, strict=True)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*_NODE, "ends_sha256"]
        )

    for batch in batches:
        done = []
        for *node, conv_id in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "conv_id")], strict=True):
            if node != held:
                if held is not None:
                    done.append((*held, running.hexdigest()))
                held, running = node, hashlib.sha256(str(conv_id).encode())
            else:
                running.update(f",{conv_id}".encode())
        if done:
            yield out(done)
    if held is not None:
        yield out([(*held, running.hexdigest())])


def _named_nodes(turns: DataFrame, base: Callable, head: Callable, most: int, seeds: range) -> tuple[DataFrame, DataFrame]:
    """(members, nodes), for the first bases under which no two sequences share a name."""
    pairs = ["prev_a", "prev_b", "check_a", "check_b", "bytes"]
    for seed in seeds:
        bases = lane_bases(seed)
        members = _members(_prefixes(turns, bases), bases, base, head, most)
        agree = reduce(and_, [F.min(x) == F.max(x) for x in pairs])
        nodes = written(
            members.groupBy(*_NODE).agg(
                F.min("conv_id").alias("conv_id"),
                F.count("*").alias("n_convs"),
                *[F.min(x).alias(x) for x in pairs[:2]],
                F.max("bytes").alias("bytes"),
                agree.alias("same"),
            ),
            "nodes",
        )
        if nodes.where(~F.col("same")).isEmpty():
            return members, nodes
    raise RuntimeError("no bases keep all sequences apart")


def prefix_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    base: Callable[[Column], Column] = base_of,
    head: Callable[[Column], Column] = head_of,
    most: int = HEADS - 1,
) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    `base` names the conversation whose first `head` turns come in front of the
    own ones after the same number; `most` bounds `head`.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turns = picked(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv_id IS NOT NULL")
    members, named = _named_nodes(turns, base, head, most, range(8))

    above = [(F.col("depth") - 1).alias("depth"), F.col("prev_a").alias("a"), F.col("prev_b").alias("b")]
    children = named.where("depth > 0").select(*above).groupBy(*_NODE).agg(F.count("*").alias("n_children"))
    parents = named.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("prev_a"),
        F.col("b").alias("prev_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = written(
        named.join(parents, ["depth", "prev_a", "prev_b"], "left")
        .join(children, _NODE, "left")
        .select(
            *_NODE,
            "conv_id",
            F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
            F.floor(F.col("depth") / BLOCK).alias("block"),
        ),
        "trie",
    )
    of_conv = Window.partitionBy("conv_id")
    later = of_conv.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    leaf = (F.col("n_children") == 0).cast("long")
    blocks = written(
        nodes.groupBy("conv_id", "block")
        .agg(F.sum("saved").alias("saved"), F.sum(leaf).alias("leaves"), F.min("depth").alias("first"))
        .select(
            "conv_id",
            "block",
            F.coalesce(F.sum("saved").over(later), F.lit(0)).alias("later"),
            F.sum("saved").over(of_conv).alias("all_saved"),
            F.sum("leaves").over(of_conv).alias("all_leaves"),
            F.min("first").over(of_conv).alias("from"),
            (F.row_number().over(of_conv.orderBy("block")) == 1).alias("one"),
        ),
        "stand-for",
    )
    # What the other members of a node stand for lies below it as a whole.
    stands = blocks.where("one AND (all_saved > 0 OR all_leaves > 0)").select("conv_id", "from", "all_saved", "all_leaves")
    below = (
        members.join(stands, "conv_id")
        .where(F.col("depth") < F.col("from"))
        .groupBy(*_NODE)
        .agg(F.sum("all_saved").alias("below_saved"), F.sum("all_leaves").alias("below_leaves"))
    )
    ends = (
        members.where("ends = 1")
        .select(*_NODE, "conv_id")
        .repartition(*_NODE)
        .sortWithinPartitions(*_NODE, "conv_id")
        .mapInArrow(_ends, "depth long, a long, b long, ends_sha256 string")
    )
    deeper = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    own = (
        nodes.withColumn("own_saved", F.sum("saved").over(deeper))
        .join(blocks.select("conv_id", "block", "later", "all_leaves"), ["conv_id", "block"])
    )
    return (
        own.join(below, _NODE, "left")
        .join(ends, _NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("all_leaves") + F.coalesce("below_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("own_saved") + F.col("later") + F.coalesce("below_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
