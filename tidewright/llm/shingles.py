"""Hashed words and word windows of many texts at once, for tasks."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def word_hashes(split: list[list[bytes]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words of each text); texts follow each other."""
    counts = np.array([len(w) for w in split], np.int64)
    names = _Names()
    ids = np.fromiter(map(names.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), np.uint64, len(names))
    return hashes[ids], counts


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive words, across texts too."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        total = mix(total * _STEP + words[k : k + n])
    return total


def shingle_sets(split: list[list[bytes]], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than `width` make one shingle, none make none."""
    words, counts = word_hashes(split)
    windows = window_hashes(words, width)
    stops = np.cumsum(counts)
    sets = []
    for stop, n in zip(stops.tolist(), counts.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(windows[stop - n : stop - width + 1]))
        else:
            sets.append(window_hashes(words[stop - n : stop], n) if n else np.zeros(0, np.uint64))
    return sets
