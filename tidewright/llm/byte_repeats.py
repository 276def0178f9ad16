"""Repeated byte strings across all texts.

1. Each window of `window` bytes is named by the least hash of its `SEED_BYTES`
   -byte substrings, which depends on the window alone. A Spark round finds the
   names that stand in one place only; windows with such a name can't repeat.
2. The windows that remain form pieces: runs of consecutive windows of one name,
   with all their bytes. Each distinct piece of a chunk goes to the bucket of its
   name, where equal windows meet. Copies of a piece are recognised as a whole.
   Where a name has different pieces, a Burrows-Wheeler transform of them is
   expanded to the window length (see `interval_expansion`), which gives the
   classes of equal windows; the earliest window of a class stays.
3. Names that stand HOT times or more would gather too many pieces in one bucket.
   Their windows are dealt out one by one by a 104-bit hash of their bytes
   instead (beside the bucket's own bits), once per chunk.

Texts are shuffled once and read by three passes; what goes between are packed
values, pieces and bits (see `packed`).

Defined cases: null and empty texts have no bytes; documents are ordered by
(id, text) with null ids last, so repeated ids and rows have a fixed order
within their chunk and by chunk number beyond; texts shorter than the window
keep all; periodic texts, in which a window overlaps its own copy, count like
any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidewright.llm import packed
from tidewright.llm.interval_expansion import repeat_classes
from tidewright.llm.recompression import Windows, cover, later_answers, sequence_hashes, spans, window_pairs
from tidewright.llm.shingles import mix

WINDOW = 100
SEED_BYTES = 40
HOT = 4096
BLOCK_BYTES = 1_000_000
RESULT = "doc_id long, n_bytes long, n_removed long, starts array<int>, stops array<int>, kept binary"

_TABLES = np.random.default_rng(2024).integers(0, 1 << 64, (3, 256), np.uint64)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or largest of every `width` consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Named:
    """Names of a chunk's windows."""

    def __init__(self, texts: list[bytes], window: int, seed: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        self.window, n = window, len(self.data)
        self.valid = np.zeros(0, bool)
        self.values = self.counts = self.run_start = self.run_length = self.run_value = np.zeros(0, np.uint64)
        self.close = np.zeros(0, bool)
        if n < window:
            return
        hashed = sequence_hashes(_TABLES[2][self.data], seed, 0x27BB2EE687B0B0FD)
        reach = window - seed + 1
        least = sliding(hashed, reach, np.minimum)
        self.valid = self.owner[: n - window + 1] == self.owner[window - 1 :]
        # A seed counts where it names a window; its places tell how often a name stands.
        padded = np.zeros(len(least) + 2 * (reach - 1), np.uint64)
        padded[reach - 1 : reach - 1 + len(least)] = np.where(self.valid, least, 0)
        places = np.flatnonzero(sliding(padded, reach, np.maximum) == hashed)
        # Least hashes crowd at the low end; mixed, they fill the buckets evenly.
        named = mix(hashed[places])
        order = np.argsort(named, kind="stable")
        ordered, at = named[order], places[order]
        first = np.ones(len(order), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        near = np.zeros(len(order), bool)
        near[1:] = ~first[1:] & (np.diff(at) <= reach)
        begins = np.flatnonzero(first)
        self.values = ordered[begins]
        self.counts = np.diff(np.append(begins, len(ordered)))
        # Names whose seed stands twice within reach: their pieces may repeat in themselves.
        self.close = np.logical_or.reduceat(near, begins) if len(begins) else near
        head = np.ones(len(least), bool)
        head[1:] = (least[1:] != least[:-1]) | (self.valid[1:] != self.valid[:-1]) | (
            self.owner[1 : len(least)] != self.owner[: len(least) - 1]
        )
        start = np.flatnonzero(head)
        length = np.diff(np.append(start, len(least)))
        good = self.valid[start]
        self.run_start, self.run_length, self.run_value = start[good], length[good], mix(least[start[good]])


def _body(values, lengths, starts, close, strings: list[bytes]) -> bytes:
    n = np.array([len(strings)], "<u4").tobytes()
    columns = (values.astype("<u8"), lengths.astype("<u4"), starts.astype("<u4"), close.astype(np.uint8))
    return n + b"".join(c.tobytes() for c in columns) + b"".join(strings)


def _from_body(body: bytes):
    n = int(np.frombuffer(body, "<u4", 1)[0])
    values = np.frombuffer(body, "<u8", n, 4)
    lengths = np.frombuffer(body, "<u4", n, 4 + 8 * n).astype(np.int64)
    starts = np.frombuffer(body, "<u4", n, 4 + 12 * n)
    close = np.frombuffer(body, np.uint8, n, 4 + 16 * n)
    stops = 4 + 17 * n + np.cumsum(lengths)
    strings = [body[e - k : e] for e, k in zip(stops.tolist(), lengths.tolist(), strict=True)]
    return values.tolist(), strings, starts.tolist(), close.tolist()


def _name(n_chunks: int, window: int, seed: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table) -> pa.Table:
        _, texts = packed.in_order(chunk)
        found = Named(texts, window, seed)
        return packed.messages(packed.value_messages(found.values, found.counts, key[0].as_py(), n_chunks))

    return run


def _repeated(hot: int):
    def run(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        return packed.answers(packed.value_answers(bucket, {0: 2, 1: hot}))

    return run


def _ask(n_chunks: int, window: int, seed: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table, back: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return packed.messages([])
        number = key[0].as_py()
        ids, texts = packed.in_order(chunk)
        found = Named(texts, window, seed)
        repeated = packed.read_answers(found.values, packed.told(back, 0), n_chunks)
        hot = packed.read_answers(found.values, packed.told(back, 1), n_chunks)
        at = np.searchsorted(found.values, found.run_value)
        open_ = repeated[at] if len(at) else np.zeros(0, bool)
        start, length, at = found.run_start[open_].astype(np.int64), found.run_length[open_].astype(np.int64), at[open_]
        order_of = packed.id_order(ids)
        rows = []
        # Hot names: single windows.
        is_hot = hot[at] if len(at) else np.zeros(0, bool)
        hot_start, hot_length = start[is_hot], length[is_hot]
        if len(hot_start):
            windows = _single(found.data, _expanded(hot_start, hot_length), window)
            rows += [(b, c, 3, body, docs) for b, c, _, body, docs in windows.messages(found.owner, order_of, number, n_chunks)]
        # The others: distinct pieces, the earliest first.
        start, length, at = start[~is_hot], length[~is_hot], at[~is_hot]
        first, cuts = np.zeros(0, bool), []
        if len(start):
            stop = start + length + window - 1
            raw = found.data.tobytes()
            digests = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
            one, two = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2).T
            order = np.lexsort((start, two, one, at))
            start, length, stop, at, one, two = (x[order] for x in (start, length, stop, at, one, two))
            first = np.ones(len(start), bool)
            first[1:] = (at[1:] != at[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            values, close = found.values[at[first]], found.close[at[first]]
            own_start, own_stop = start[first], stop[first]
            docs = order_of[found.owner[own_start]]
            strings = [raw[a:b] for a, b in zip(own_start.tolist(), own_stop.tolist(), strict=True)]
            cuts = packed.bucket_cuts(values, n_chunks)
            rows += [
                (bucket, number, 1,
                 _body(values[a:b], own_stop[a:b] - own_start[a:b], own_start[a:b], close[a:b], strings[a:b]),
                 packed.pack_ids(docs[a:b]))
                for bucket, a, b in cuts
            ]
        # What was asked goes back to the chunk unchanged.
        for kind, values in (
            (10, start), (11, length), (12, hot_start), (13, hot_length), (14, np.array(cuts, np.int64).reshape(-1)),
        ):
            rows.append((-1 - number, number, kind, values.astype("<i8" if kind == 14 else "<u4").tobytes(), b""))
        rows.append((-1 - number, number, 15, packed.bits(first), b""))
        return packed.messages(rows)

    return run


def _expanded(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


def _single(data: np.ndarray, starts: np.ndarray, window: int) -> Windows:
    starts = np.sort(starts)
    return Windows(*window_pairs(_TABLES[0][data], _TABLES[1][data], starts, window), starts)


def _answer(window: int):
    def run(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        rows = bucket.to_pylist()
        out = [(r["chunk"], r["bucket"], r["kind"], r["body"]) for r in rows if r["kind"] >= 10]
        hot = [r for r in rows if r["kind"] == 3]
        pieces = [r for r in rows if r["kind"] == 1]
        return packed.answers(
            out + (later_answers(hot, 13, 3) if hot else []) + (_piece_answers(pieces, window) if pieces else [])
        )

    return run


def _piece_answers(rows: list[dict], window: int) -> list[tuple]:
    """Per chunk: bits of pieces that stand earlier as a whole, bits of compared pieces, bits of their windows."""
    of_value: dict[int, dict[bytes, list[tuple]]] = {}
    inner: set[int] = set()
    counts = []
    for r, row in enumerate(rows):
        values, strings, starts, close = _from_body(row["body"])
        docs, chunk = packed.unpack_ids(row["docs"]).tolist(), row["chunk"]
        counts.append(len(values))
        for e, (value, string, start, doc) in enumerate(zip(values, strings, starts, docs, strict=True)):
            of_value.setdefault(value, {}).setdefault(string, []).append((doc, chunk, start, r, e))
        inner.update(v for v, c in zip(values, close, strict=True) if c)
    later = [np.zeros(n, bool) for n in counts]
    compared = [np.zeros(n, bool) for n in counts]
    windows: dict[tuple[int, int], np.ndarray] = {}
    block, size = [], 0

    def settle():
        if block:
            for (r, e), flags in _compare(block, window):
                windows[r, e] = flags

    for value, strings in of_value.items():
        earliest = []
        for string, places in strings.items():
            best = min(places)
            for place in places:
                if place is not best:
                    later[place[3]][place[4]] = True
            earliest.append((best, string))
        if len(earliest) > 1 or value in inner:
            block += earliest
            size += sum(len(s) for _, s in earliest)
            for best, _ in earliest:
                compared[best[3]][best[4]] = True
        if size >= BLOCK_BYTES:
            settle()
            block, size = [], 0
    settle()
    out = []
    for r, row in enumerate(rows):
        own = [windows[r, e] for e in np.flatnonzero(compared[r]).tolist()]
        body = packed.bits(later[r]) + packed.bits(compared[r])
        out.append((row["chunk"], row["bucket"], 1, body + packed.bits(np.concatenate(own) if own else np.zeros(0, bool))))
    return out


def _compare(block: list[tuple[tuple, bytes]], window: int):
    """For every piece, which of its windows stand in an earlier place of the block."""
    # In order of (document, chunk, place), an earlier window stands earlier in the block.
    block = sorted(block, key=lambda x: x[0][:3])
    lengths = np.array([len(s) for _, s in block], np.int64)
    text = np.frombuffer(b"".join(s for _, s in block), np.uint8)
    inside = np.ones(len(text), bool)
    stops = np.cumsum(lengths)
    inside[_expanded(stops - window + 1, np.full(len(block), window - 1))] = False
    places, classes = repeat_classes(text, window)
    good = inside[places]
    places, classes = places[good], classes[good]
    again = np.zeros(len(text), bool)
    if len(places):
        begins = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
        first = np.minimum.reduceat(places, begins)
        again[places] = places != np.repeat(first, np.diff(np.append(begins, len(places))))
    for (best, string), stop in zip(block, stops.tolist(), strict=True):
        yield (best[3], best[4]), again[stop - len(string) : stop - window + 1]


def _remove(n_chunks: int, window: int):
    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table, back: pa.Table) -> pa.Table:
        ids, texts = packed.in_order(chunk)
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        removed = np.zeros(n, bool)
        held = {r["kind"]: r["body"] for r in back.to_pylist() if r["kind"] >= 10}
        if held and n >= window:
            start, length = (np.frombuffer(held[k], "<u4").astype(np.int64) for k in (10, 11))
            hot_start, hot_length = (np.frombuffer(held[k], "<u4").astype(np.int64) for k in (12, 13))
            cuts = np.frombuffer(held[14], "<i8").reshape(-1, 3).tolist()
            first = packed.from_bits(held[15], len(start))
            gone = [np.zeros(0, np.int64)]
            if len(start):
                gone.append(_expanded(start[~first], length[~first]))
                own_start, own_length = start[first], length[first]
                told = packed.told(back, 1)
                for bucket, a, b in cuts:
                    body, m = told[bucket], -(-(b - a) // 8)
                    later = packed.from_bits(body[:m], b - a)
                    compared = packed.from_bits(body[m : 2 * m], b - a)
                    s, k = own_start[a:b], own_length[a:b]
                    gone.append(_expanded(s[later], k[later]))
                    asked = _expanded(s[compared], k[compared])
                    gone.append(asked[packed.from_bits(body[2 * m :], len(asked))])
            if len(hot_start):
                windows = _single(data, _expanded(hot_start, hot_length), window)
                told, later = packed.told(back, 3), ~windows.first
                flags = np.zeros(len(windows.high), bool)
                for bucket, a, b in packed.bucket_cuts(windows.high, n_chunks):
                    flags[a:b] = packed.from_bits(told[bucket], b - a)
                later[windows.first] = flags
                gone.append(windows.starts[later])
            removed = cover(n, np.concatenate(gone), window)
        rows, at = [], 0
        for number, text in zip(ids, texts, strict=True):
            mask = removed[at : at + len(text)]
            if mask.any():
                a, b = spans(mask)
                kept = data[at : at + len(text)][~mask].tobytes()
                rows.append((number, len(text), int(mask.sum()), a, b, kept))
            else:
                rows.append((number, len(text), 0, [], [], text))
            at += len(text)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())] * 2 + [pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.table(arrays, names=[x.split()[0] for x in RESULT.split(", ")])

    return run


def without_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    seed: int = SEED_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """Every document without the bytes of windows that start earlier elsewhere.

    n_bytes, n_removed, the removed spans (bytes from `starts` up to `stops`,
    as long as possible) and the bytes that stay.
    """
    texts, n = packed.chunked(docs, id_col, text_col)
    by_chunk = texts.groupBy("chunk")
    named = by_chunk.applyInArrow(_name(n, window, seed), packed.MESSAGES)
    repeated = named.groupBy("bucket").applyInArrow(_repeated(hot), packed.ANSWERS)
    asked = by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(_ask(n, window, seed), packed.MESSAGES)
    told = asked.groupBy("bucket").applyInArrow(_answer(window), packed.ANSWERS)
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_remove(n, window), RESULT)
