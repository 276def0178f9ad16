"""Long repeats in a block of strings by bounded interval expansion.

The suffixes of the block are sorted as far as `least` bytes reach, which gives
a Burrows-Wheeler transform: row r stands for a suffix, and stepping back by
the byte before it leads to another row. Common prefixes are found by
increasing value: rows where neighbouring suffixes differ in the first byte
bound the intervals of value 0, and a boundary of value v inside an interval
becomes one of value v + 1 for every byte that precedes suffixes on both of its
sides. The expansion goes breadth first and stops at `least`: rows that have no
boundary by then share their first `least` bytes with the row before.
"""

from __future__ import annotations

import numpy as np


def suffix_rows(text: np.ndarray, least: int) -> np.ndarray:
    """Places of `text` ordered by their next 8 * 2^k >= `least` bytes (zeros follow the end), ties by place."""
    n = len(text)
    held = np.concatenate((text, np.zeros(8, np.uint8)))
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | held[k : n + k]
    order = np.argsort(packed, kind="stable")
    rank = _ranks(packed[order], order)
    depth = 8
    while depth < least:
        following = np.zeros(n, np.int64)
        following[: max(0, n - depth)] = rank[depth:] + 1
        # Only rows whose prefix is not alone are sorted again.
        count = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(count[rank[order]] > 1)
        if not len(open_):
            break
        places = order[open_]
        key = (rank[places].astype(np.uint64) << np.uint64(32)) | following[places].astype(np.uint64)
        again = np.argsort(key, kind="stable")
        order[open_] = places[again]
        sorted_key = key[again]
        fresh = np.empty(len(open_), bool)
        fresh[0] = True
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        # A rank is the row of the first suffix with the same prefix.
        first = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        rank[order[open_]] = first
        depth *= 2
    return order


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = first
    return rank


def repeat_classes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in suffix order, class of each): equal classes share their next `least` bytes.

    Bytes after the end of the text count as zeros.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The text goes on with zeros, so that each place has a suffix of `least` bytes.
    whole = np.concatenate((text, np.zeros(least, np.uint8)))
    total = len(whole)
    order = suffix_rows(whole, least).astype(np.int32)
    row_of = np.empty(total, np.int32)
    row_of[order] = np.arange(total, dtype=np.int32)
    # Row of the suffix one byte longer, by the byte before; the text's first place has none.
    back = np.where(order > 0, row_of[order - 1], -1)
    # For a row, the row from which the row before its image comes.
    ahead = np.where(order < total - 1, row_of[np.minimum(order + 1, total - 1)], -1)
    byte = whole[order]
    bound = np.zeros(total + 1, bool)
    bound[0] = bound[total] = True
    bound[1:total] = byte[1:] != byte[:-1]
    fresh = np.flatnonzero(bound[:total])
    fresh = fresh[fresh > 0]
    for _ in range(1, least):
        if not len(fresh):
            break
        found = _extended(fresh, bound, back, ahead, byte)
        bound[found] = True
        fresh = found
    classes = np.cumsum(bound[:total]) - 1
    inside = order < n
    return order[inside], classes[inside]


def _extended(fresh: np.ndarray, bound: np.ndarray, back: np.ndarray, ahead: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Rows that get a boundary because a fresh one parts what they and the row before them go on with.

    Of an interval that begins with a fresh boundary all rows step back; the row
    they reach is new if the row before it, of the same first byte, steps
    forward to a place before that boundary.
    """
    edges = np.flatnonzero(bound)
    stops = edges[np.searchsorted(edges, fresh, side="right")]
    lengths = stops - fresh
    rows = np.repeat(fresh - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
    starts = np.repeat(fresh, lengths)
    reached = back[rows]
    good = reached > 0
    rows, starts, reached = rows[good], starts[good], reached[good]
    before = reached - 1
    good = ~bound[reached] & (byte[reached] == byte[before]) & (ahead[before] < starts)
    return np.unique(reached[good])
