"""Repeated word sequences by recompression.

A text is a sequence of symbols, at first its words. One round names runs of
one word, each of the next rounds names pairs: a hash of the symbol's name puts
it on the left or the right side, and every left symbol followed by a right one
becomes one symbol. Names are hashes of what they stand for, so all tasks agree
on them and no dictionary is passed around. Whether two symbols pair depends on
them alone; so equal substrings get equal symbols but for at most one symbol at
either end in each round, and which symbols of a window are safe is computed
for every window.

A Spark round then finds which names of the last level stand in one place only.
A window with such a name among its safe symbols can't repeat and is left out.
For the windows that remain, a second Spark round compares 128-bit hashes of
their whole word sequences (40 + 64 bits within a bucket) and finds the
earliest place of each.

Every chunk of texts takes part in three passes over one shuffle of the texts;
what goes between are packed values and bits (see `packed`).

Defined cases: null and empty texts have no words; documents are ordered by
(id, text) with null ids last, so repeated ids and rows have a fixed order
within their chunk and by chunk number beyond; a document of fewer words than
the window keeps all; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewright.llm import packed
from tidewright.llm.common import space_words
from tidewright.llm.shingles import mix, word_hashes

WINDOW = 20
ROUNDS = 4
RESULT = "doc_id long, n_words long, n_removed long, starts array<int>, stops array<int>, text string"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _next_level(symbols, owner, spread, side_seed: int):
    """Pairs left symbols with right ones: (symbols, owner, spread, place of each old symbol, right flags)."""
    right = (mix(symbols + np.uint64(side_seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
    pairs = np.zeros(len(symbols), bool)
    if len(symbols) > 1:
        pairs[:-1] = ~right[:-1] & right[1:] & (owner[:-1] == owner[1:])
    second = np.zeros(len(symbols), bool)
    second[1:] = pairs[:-1]
    named = symbols.copy()
    at = np.flatnonzero(pairs)
    named[at] = mix(mix(symbols[at] + _A) + symbols[at + 1] * _B)
    kept = ~second
    return named[kept], owner[kept], spread[kept], np.cumsum(kept) - 1, right


class Parsed:
    """Symbols of the last level of a chunk, and for every window the range of its safe symbols."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, window: int, rounds: int):
        n = len(words)
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = np.arange(n - window + 1)
        starts = starts[owner[: n - window + 1] == owner[window - 1 :]] if n >= window else np.zeros(0, np.int64)
        self.starts = starts
        # Runs of one word. The runs at both ends of a window may go on outside it.
        head = np.ones(n, bool)
        head[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        run = np.cumsum(head) - 1
        first = np.flatnonzero(head)
        length = np.diff(np.append(first, n)).astype(np.uint64)
        symbols = np.where(length > 1, mix(words[first] + length * _B), words[first])
        own, spread = owner[first], first
        low = run[starts] + 1
        high = run[starts + window - 1] if len(starts) else low
        for k in range(1, rounds + 1):
            symbols, own, spread, place, right = _next_level(symbols, own, spread, k)
            if not len(starts):
                continue
            some = low < high
            low = low + (some & right[np.minimum(low, len(right) - 1)])
            some = low < high
            high = high - (some & ~right[high - 1])
            some = low < high
            low = np.where(some, place[np.minimum(low, len(place) - 1)], 0)
            high = np.where(some, place[high - 1] + 1, 0)
        self.symbols, self.low, self.high = symbols, low, high

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct names and how often they stand in the chunk."""
        return np.unique(self.symbols, return_counts=True)

    def candidates(self, values: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        """Windows without a name that stands in one place only."""
        alone = ~repeated[np.searchsorted(values, self.symbols)]
        before = np.concatenate(([0], np.cumsum(alone)))
        return (self.low >= self.high) | (before[self.high] == before[self.low])


def sequence_hashes(values: np.ndarray, window: int, base: int) -> np.ndarray:
    """Hash of every `window` consecutive values, put together from powers of two."""
    if len(values) < window:
        return np.zeros(0, np.uint64)
    total, width, power = None, 0, base
    part, size = values, 1
    while True:
        if window & size:
            # What is there so far, followed by `size` more values.
            total = part if total is None else total[: len(values) - width - size + 1] * np.uint64(
                pow(base, size, 1 << 64)
            ) + part[width : len(values) - size + 1]
            width += size
        size *= 2
        if size > window:
            return mix(total)
        part = part[: -(size // 2)] * np.uint64(power) + part[size // 2 :]
        power = power * power & (1 << 64) - 1


def window_pairs(values: np.ndarray, again: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows at the given starts."""
    high = sequence_hashes(values, window, 0x5851F42D4C957F2D)[starts]
    return high, sequence_hashes(again, window, 0x14057B7EF767814F)[starts]


class Windows:
    """The chunk's candidate windows in order of their hash, the earliest of each sequence first."""

    def __init__(self, high: np.ndarray, low: np.ndarray, starts: np.ndarray):
        order = np.argsort(high, kind="stable")
        high, low = high[order], low[order]
        first = np.ones(len(order), bool)
        first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.starts, self.first = starts[order], first
        self.high, self.low = high[first], low[first]

    def messages(self, owners: np.ndarray, ids: np.ndarray, chunk: int, n_buckets: int) -> list[tuple]:
        docs = ids[owners[self.starts[self.first]]]
        body = np.concatenate((packed.low_bytes(self.high, 5), packed.low_bytes(self.low, 8)), axis=1)
        return [
            (bucket, chunk, 1, body[a:b].tobytes(), packed.pack_ids(docs[a:b]))
            for bucket, a, b in packed.bucket_cuts(self.high, n_buckets)
        ]


def later_answers(rows: list[dict], width: int, kind: int) -> list[tuple]:
    """For every chunk, one bit per entry: an equal entry stands in an earlier document."""
    sent = [np.frombuffer(r["body"], np.uint8).reshape(-1, width) for r in rows]
    docs = np.concatenate([packed.unpack_ids(r["docs"]) for r in rows])
    chunk = np.concatenate([np.full(len(s), r["chunk"], np.int64) for r, s in zip(rows, sent, strict=True)])
    body = np.concatenate(sent)
    high, low = packed.from_low_bytes(body[:, :5]), packed.from_low_bytes(body[:, 5:13])
    order = np.lexsort((chunk, docs, low, high))
    same = np.zeros(len(order), bool)
    same[1:] = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    later = np.empty(len(order), bool)
    later[order] = same
    out, at = [], 0
    for r, s in zip(rows, sent, strict=True):
        out.append((r["chunk"], r["bucket"], kind, packed.bits(later[at : at + len(s)])))
        at += len(s)
    return out


def _name(n_chunks: int, window: int, rounds: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table) -> pa.Table:
        _, texts = packed.in_order(chunk)
        words, counts = word_hashes([space_words(t) for t in texts])
        values, often = Parsed(words, counts, window, rounds).names()
        return packed.messages(packed.value_messages(values, often, key[0].as_py(), n_chunks))

    return run


def _ask(n_chunks: int, window: int, rounds: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table, back: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return packed.messages([])
        number = key[0].as_py()
        ids, texts = packed.in_order(chunk)
        split = [space_words(t) for t in texts]
        words, counts = word_hashes(split)
        parsed = Parsed(words, counts, window, rounds)
        values, _ = parsed.names()
        open_ = parsed.candidates(values, packed.read_answers(values, packed.told(back, 0), n_chunks))
        again, _ = word_hashes(split, 1)
        asked = parsed.starts[open_]
        found = Windows(*window_pairs(words, again, asked, window), asked)
        owners = np.repeat(np.arange(len(counts)), counts)
        rows = found.messages(owners, packed.id_order(ids), number, n_chunks)
        # Which windows were asked about goes back to the chunk unchanged.
        rows.append((-1 - number, number, 2, packed.bits(open_), b""))
        return packed.messages(rows)

    return run


def _answer(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
    rows = bucket.to_pylist()
    asked = [r for r in rows if r["kind"] == 1]
    passed = [(r["chunk"], r["bucket"], 2, r["body"]) for r in rows if r["kind"] == 2]
    return packed.answers(passed + (later_answers(asked, 13, 1) if asked else []))


def _repeated(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
    return packed.answers(packed.value_answers(bucket, {0: 2}))


def spans(covered: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()


def cover(n: int, starts: np.ndarray, width) -> np.ndarray:
    """Places inside any span of `width` from the starts."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + width, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:-1]) > 0


def _remove(n_chunks: int, window: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table, back: pa.Table) -> pa.Table:
        ids, texts = packed.in_order(chunk)
        split = [space_words(t) for t in texts]
        words, counts = word_hashes(split)
        n, owner = len(words), np.repeat(np.arange(len(counts)), counts)
        starts = np.arange(max(0, n - window + 1))
        starts = starts[owner[: len(starts)] == owner[window - 1 :]] if n >= window else starts
        removed = np.zeros(n, bool)
        if len(starts):
            open_ = packed.from_bits(next(iter(packed.told(back, 2).values())), len(starts))
            again, _ = word_hashes(split, 1)
            found = Windows(*window_pairs(words, again, starts[open_], window), starts[open_])
            answers, later = packed.told(back, 1), ~found.first
            of_first = np.zeros(len(found.high), bool)
            for bucket, a, b in packed.bucket_cuts(found.high, n_chunks):
                of_first[a:b] = packed.from_bits(answers[bucket], b - a)
            later[found.first] = of_first
            removed = cover(n, found.starts[later], window)
        rows, at = [], 0
        for number, own in zip(ids, split, strict=True):
            gone = removed[at : at + len(own)]
            at += len(own)
            if gone.any():
                a, b = spans(gone)
                kept = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
                rows.append((number, len(own), int(gone.sum()), a, b, b" ".join(kept)))
            else:
                rows.append((number, len(own), 0, [], [], b" ".join(own)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())] * 2
        arrays = [pa.array(c, k) for c, k in zip(columns[:5], kinds, strict=True)]
        arrays.append(pa.array(columns[5], pa.binary()).cast(pa.string()))
        return pa.table(arrays, names=[x.split()[0] for x in RESULT.split(", ")])

    return run


def without_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS
) -> DataFrame:
    """Every document without the words of windows that start earlier elsewhere.

    n_words, n_removed, the removed spans (words from `starts` up to `stops`)
    and the words that stay, joined by one space.
    """
    texts, n = packed.chunked(docs, id_col, text_col)
    by_chunk = texts.groupBy("chunk")
    named = by_chunk.applyInArrow(_name(n, window, rounds), packed.MESSAGES)
    repeated = named.groupBy("bucket").applyInArrow(_repeated, packed.ANSWERS)
    asked = by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(_ask(n, window, rounds), packed.MESSAGES)
    told = asked.groupBy("bucket").applyInArrow(_answer, packed.ANSWERS)
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_remove(n, window), RESULT)
