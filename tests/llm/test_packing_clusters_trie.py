"""Packing, centroid clustering and the prefix trie against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import centroids, packing, prefix_trie

CLASH = "DOC_ID string, `a.b` int, length string, part int, ids int, sequence int, n long, `c0` int"
EXTRA = ("x", 1, "y", 2, 3, 4, 5, 6)


def _plainly(lengths, capacity):
    """What is left of every sequence when pieces are placed one by one."""
    bounds, weights = np.array(capacity.bounds, float), np.array(capacity.weights)
    bins = []
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length])
        best = None
        for i, left in enumerate(bins):
            if (left >= need).all():
                rest, part = left / bounds, need / bounds
                tight = ((rest - part) ** 2 * weights).sum() if capacity.score == "norm" else (rest * part * weights).sum()
                if best is None or tight < best[0] - 1e-15:
                    best = tight, i
        if best is None:
            bins.append(np.array(capacity.bounds) - need)
        else:
            bins[best[1]] -= need
    return sorted(tuple(map(int, b)) for b in bins)


@pytest.mark.parametrize(
    "capacity",
    [
        packing.Capacity(64),
        packing.Capacity(64, documents=5),
        packing.Capacity(64, attention=1500),
        packing.Capacity(64, documents=4, attention=2000, score="dot"),
        packing.Capacity(1),
    ],
)
def test_steps_place_pieces_as_one_by_one(capacity):
    rng = random.Random(8)
    for _ in range(4):
        lengths = [rng.randint(1, capacity.longest_piece) for _ in range(250)]
        counts = {x: lengths.count(x) for x in set(lengths)}
        held = {}
        for length, first, past, each, sequence, place in packing.steps(counts, capacity):
            for number in range(first, past):
                at = number - first
                held.setdefault(sequence + at // each, []).append((place + at % each * length, length))
        left = []
        for pieces in held.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            used = np.array([at, len(pieces), sum(x * x for _, x in pieces)])
            left.append(tuple(map(int, np.array(capacity.bounds) - used)))
        assert sum(map(len, held.values())) == len(lengths)
        assert sorted(left) == _plainly(lengths, capacity)
    assert packing.steps({}, capacity) == []


def test_steps_do_not_grow_with_the_documents():
    rng = np.random.default_rng(4)
    lengths, shares = np.unique(np.minimum(2048, rng.lognormal(5.5, 1.2, 200_000).astype(int) + 1), return_counts=True)
    sizes = []
    for times in (1, 1000):
        counts = {int(x): int(n) * times for x, n in zip(lengths, shares)}
        made = packing.steps(counts)
        sizes.append(len(made))
        used = max(s + (past - first - 1) // each for _, first, past, each, s, _ in made) + 1
        assert used <= 1.001 * sum(x * n for x, n in counts.items()) / 2048 + 1
    assert sizes[1] < 1.5 * sizes[0] < 15_000


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(40, documents=6)])
def test_packing_keeps_every_id(spark, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path())
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "Beta", "gam-ma", "d'e", "éa", "漢字"], k=rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "long " * 5000), (203, "x"), (203, "x"), (203, "y"), (None, "z z"), (None, None)]
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], f"doc_id long, text string, {CLASH}").repartition(5)
    found = packing.packed(docs, capacity)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    pieces = found.collect()
    want = sorted(
        ((i is None, i or 0), tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows
    )
    # Repeated ids hold several documents: their pieces are told apart by what they hold.
    whole, open_ids = [], {}
    longest = capacity.longest_piece
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= longest and zlib.crc32(r.ids) == r.ids_crc32 and r.start == r.piece * longest
        open_ids.setdefault(r.doc_id, []).append((r.piece, ids.tolist()))
    for i, parts in open_ids.items():
        if all(p == 0 for p, _ in parts):
            whole += [((i is None, i or 0), tuple(x)) for _, x in parts]
        else:
            assert [p for p, _ in sorted(parts)] == list(range(len(parts)))
            whole.append(((i is None, i or 0), tuple(x for _, part in sorted(parts) for x in part)))
    assert sorted(whole) == want
    held = {}
    for r in pieces:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(spans) <= capacity.bounds[1]
    assert len(held) == len(_plainly([r.length for r in pieces], capacity))
    by_place = {(r.sequence_id, r.offset): r.ids for r in pieces}
    for r in packing.sequences(found).collect():
        assert bytes(r.ids) == b"".join(bytes(by_place[r.sequence_id, p.offset]) for p in r.pieces)
    assert packing.packed(docs.limit(0)).count() == 0


def _clusters(vectors, k, rounds):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    means = [v for _, v in hashed[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        means = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(means)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    total = {}
    for _, j, d in out:
        total[j] = total.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i is None, i or 0), j, d, total[j], sum(total.values()), digest[j]) for i, j, d in out)


@pytest.mark.parametrize("n", [0, 3, 150])
def test_clusters_match_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=64) + 3 * (i % 5))]) for i in range(n)]
    rows += [(500 + i, v) for i, (_, v) in enumerate(rows[:10])] + rows[:2]  # copies, repeated rows
    if n:
        rows += [(None, rows[0][1]), (None, rows[1][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [math.nan] + [1.0] * 63)]
    rows += [(905, [math.inf] + [1.0] * 63), (906, [-math.inf] + [1.0] * 63)]
    extra = "VEC_ID string, `a.b` int, v int, cluster string, distance int"
    given = [(*r, "x", 1, 2, "y", 3) for r in rows]
    vectors = spark.createDataFrame(given, f"vec_id long, embedding array<float>, {extra}").repartition(3)
    found = centroids.clustered(vectors)
    assert found.columns == [x.split()[0] for x in centroids.RESULT.split(", ")]
    got = sorted(
        ((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in found.collect()
    )
    assert got == _clusters(rows, 8, 10)


def test_components_too_large_for_exact_distances_are_an_error(spark):
    vectors = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="not under"):
        centroids.clustered(vectors).collect()
    limit = centroids.largest_component(64)
    assert 64 * (2 * limit) ** 2 <= 1 << 63


def _trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest())
            turns.setdefault(conv, []).append((key, (role, text)))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in turns.items()}
    rebuilt = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + x[h:])
    nodes = {}
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            nodes.setdefault(x[:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for name in nodes:
        if name:
            children[name[:-1]] = children.get(name[:-1], 0) + 1
    for name, members in nodes.items():
        cost = (len(members) - 1) * len(name[-1][1].encode()) if name else 0
        for d in range(len(name) + 1):
            leaves[name[:d]] += name not in children
            saved[name[:d]] += cost
    out = []
    for name, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if rebuilt[c] == name)
        parent = min(nodes[name[:-1]]) if name else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(name), parent, len(members), children.get(name, 0), leaves[name], saved[name], digest))
    return sorted(out, key=str)


def _conversations(kind):
    rng = random.Random(kind)
    words = ["hello", "how are you", "", "ünïcode", "a\nb", "x" * 2000]
    rows = []
    for c in range(0, 120):
        if c % 7 == 3:
            continue
        opening = rng.choice([0, 0, 1, 2])
        for t in range(rng.randint(1, 14)):
            role = "assistant" if t % 2 else "user"
            same = t < 5 and rng.random() < 0.8
            rows.append((c, t, role, f"turn {t} of {opening}" if same else rng.choice(words)))
    if kind == "odd":
        rows += [(-7, 0, "user", "a"), (-3, None, None, None), (-3, None, "user", None), (-3, 1, None, "b"), (1000, 0, "u", "v")]
        rows += [(1001, 0, "u", "v"), (1001, 0, "u", "v"), (1001, 0, "v", "u"), (None, 0, "user", "lost"), (None, None, None, None)]
        rows += [(2000, 0, "user", "same")] * 40  # one row repeated
    if kind == "long":
        rows += [(500, t, "user", f"t{t % 3}") for t in range(3000)] + [(501, t, "user", f"t{t % 3}") for t in range(2990)]
        rows += [(502, t, "user", f"t{t % 3}") for t in range(2990)]
    return rows


@pytest.mark.parametrize("kind", ["plain", "odd", "long"])
def test_trie_matches_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 700)
    rows = _conversations(kind)
    extra = "CONV_ID string, `a.b` int, depth int, head string, n int"
    given = [(*r, "x", 1, 2, "y", 3) for r in rows]
    table = spark.createDataFrame(given, f"conv_id long, turn long, role string, text string, {extra}").repartition(4)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=str)
    if kind != "long":
        assert got == _trie(rows)
        return
    # The brute force is quadratic in length: compare the long ones among themselves by what must hold.
    by = {(c, d): r for r in got for c, d in [r[:2]]}
    root = by[min(r[0] for r in got), 0]
    assert root[5] == sum(r[4] == 0 for r in got) and root[3] == len({r[0] for r in rows})
    assert all(r[6] >= 0 and r[3] >= 1 for r in got)
    chain = [r for r in got if r[0] == 500]
    assert len(chain) == 3000 and max(r[1] for r in chain) == 3000
    shared = sum((r[3] - 1) * 2 for r in chain if r[1] > 0)
    deepest = min((r for r in chain), key=lambda r: r[1])
    assert deepest[6] == shared
    assert by[500, 3000][7] == hashlib.sha256(b"500").hexdigest()
    assert by[500, 2990][7] == hashlib.sha256(b"501,502").hexdigest()


def test_trie_of_nothing_and_other_bases_after_a_clash(spark, monkeypatch):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0
    # Bases of 1 make a hash blind to order, so different sequences clash and are told apart by the check.
    real, asked = prefix_trie.lane_bases, []

    def bases(seed):
        asked.append(seed)
        return [1] * 4 if seed == 0 else real(seed)

    monkeypatch.setattr(prefix_trie, "lane_bases", bases)
    rows = [(5, 0, "u", "a"), (5, 1, "u", "b"), (5, 2, "u", "c"), (10, 0, "u", "b"), (10, 1, "u", "a"), (10, 2, "u", "c")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=str)
    assert asked == [0, 1] and got == _trie(rows)


def test_powers_and_hash_of_joined_parts():
    bases = prefix_trie.lane_bases(0)
    exponents = np.array([0, 1, 2, 31, 1000, 10**12])
    for base in bases:
        assert prefix_trie.powers(base, exponents).tolist() == [pow(base, int(e), prefix_trie.PRIME) for e in exponents]
