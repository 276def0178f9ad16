"""Texts to token ids by way of their distinct words, a batch at a time in numpy.

White space never joins words in these tokenizers, so a worker keeps the ids of
distinct words and only new ones go through the library. A simple word is cut into
the pieces that the tokenizer splits it into, and each counts as a word from there
on: "word", "Word" and "word," share one. Word bounds, hashes, distinct words and
the gathering of ids are array operations over the whole batch; Python runs once
for each word that is new to the worker.

Words are told apart by 64-bit hashes, so two different words of a worker's table
count as equal with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

import json
import os
from hashlib import blake2b

import numpy as np
import pyarrow as pa

# Words that a worker keeps, about 30 bytes each.
HELD_WORDS = 500_000
# Longer words are hashed one by one.
_LONG = 64
_PART = 20_000
# Text that goes through the array operations at once; each byte takes some 40 meanwhile.
SLICE_BYTES = 1 << 20

# What the tokenizer of the queries does before its merges. Fixed values of its file.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
# Bytes of a simple word that stay together, by kind: letters and others; a digit stands alone.
_OTHER, _LETTER, _DIGIT = range(3)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# Bytes that a simple word may not hold: controls, the apostrophe, all beyond ASCII but the lead of Latin-1 letters.
_HARD = np.ones(256, bool)
_HARD[0x21:0x7F] = False
_HARD[[0x27, 0xC3]] = [True, False]

_random = np.random.default_rng(20240229)
_OF_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_HARD_MARK = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary; white space stays."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return letters | {32: " "}


class WordEncoder:
    """Whole texts to ids.

    Only for tokenizers in which ASCII white space always parts tokens and
    leaves none itself. If the file normalizes and splits as stated above, words
    of simple characters are normalized and split here, and the library merges
    their pieces; all others go through the whole library.
    """

    def __init__(self, path: str, end_id: int = 1, limit: int = HELD_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.end_id, self.limit = end_id, limit
        self._forget()
        self._steps = (np.zeros(0, np.uint64),) * 2
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        parts["model"].pop("merges", None)
        steps = parts["pre_tokenizer"].get("pretokenizers", []) if parts["pre_tokenizer"] else []
        self.merges = None
        if (
            parts["normalizer"] == _NORMALIZER
            and parts["model"].get("end_of_word_suffix") == "</w>"
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == _SPLIT
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and not steps[1]["add_prefix_space"]
        ):
            # The same model, held once.
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.ends = np.zeros(self.size, bool)
            for token, number in parts["model"]["vocab"].items():
                self.ends[number] = token.endswith("</w>")
            self.letters = _byte_letters()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.dtype)

    def _keep(self, kept: np.ndarray) -> None:
        """Only the words of these places stay; their counts fade."""
        lengths = self.lengths[kept]
        cuts = range(0, len(kept), _PART)
        self.flat = np.concatenate(
            [self.flat[:0], *(self.flat[_runs(self.starts[kept[i : i + _PART]], lengths[i : i + _PART])] for i in cuts)]
        )
        self.keys, self.lengths, self.uses = self.keys[kept], lengths, self.uses[kept] >> 1
        self.starts = (np.cumsum(lengths) - lengths).astype(np.int32)

    def _simple(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, length of each); a piece ends with the one token that closes a word."""
        ids, stops, at = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)], 0
        for start in range(0, len(pieces), _PART):
            text = b" ".join(pieces[start : start + _PART]).decode("latin-1").translate(self.letters)
            found = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ids.append(found)
            stops.append(at + np.flatnonzero(self.ends[found]) + 1)
            at += len(found)
        lengths = np.diff(np.concatenate(stops), prepend=0)
        if len(lengths) != len(pieces):
            raise ValueError("the model does not close each piece with one token")
        return np.concatenate(ids), lengths

    def _hard(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        lengths = np.array([len(x) for x in found], np.int64)
        return np.array([i for x in found for i in x], self.dtype), lengths

    def _learn(self, keys: np.ndarray, words: list[bytes], hard: np.ndarray) -> None:
        order = np.concatenate([np.flatnonzero(~hard), np.flatnonzero(hard)])
        parts = [
            learn([words[i] for i in np.flatnonzero(which).tolist()])
            for learn, which in ((self._simple, ~hard), (self._hard, hard))
        ]
        lengths = np.concatenate([p[1] for p in parts]).astype(np.int32)
        new_starts = (len(self.flat) + np.cumsum(lengths) - lengths).astype(np.int32)
        self.flat = np.concatenate([self.flat, parts[0][0], parts[1][0]])
        by_key = np.argsort(keys[order])
        keys = keys[order][by_key]
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, new_starts[by_key])
        self.lengths = np.insert(self.lengths, at, lengths[by_key])
        self.uses = np.insert(self.uses, at, 0)

    def _powers_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._steps[0]) < n:
            self._steps = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self._steps

    def _cut(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first and past byte of every word, whether it is hard, bytes in lower case where words are simple).

        Simple words are cut into their pieces here.
        """
        word = ~_SPACE[raw]
        edges = np.flatnonzero(np.diff(word, prepend=False))
        starts, stops = edges[::2], edges[1::2]
        if self.merges is None or not len(starts):
            return starts, stops, np.ones(len(starts), bool), raw
        lower = _LOWER[raw]
        tail = np.flatnonzero(raw[:-1] == 0xC3) + 1
        second = raw[tail]
        bad = _HARD[raw]
        if len(tail):
            # Latin-1 letters in simple pairs of cases; the two signs among them and a lone lead stay hard.
            letter = (second >= 0x80) & (second <= 0xBF) & ((second & 0x1F) != 0x17) & (second != 0x9F)
            bad[tail] = ~letter
            lower[tail] = second + ((second < 0x9F) & letter).astype(np.uint8) * 32
        bad[:-1] |= (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
        held = np.append(0, np.cumsum(bad, dtype=np.int32))
        hard = held[stops] > held[starts]
        kind = _KIND[raw]
        first = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & word
        if hard.any():
            own = np.flatnonzero(hard)
            places = _runs(starts[own], stops[own] - starts[own])
            lower[places] = raw[places]
            first[places] = False
        first[starts] = True
        cuts = np.flatnonzero(first)
        of = np.searchsorted(starts, cuts, side="right") - 1
        return cuts, np.minimum(np.append(cuts[1:], len(raw)), stops[of]), hard[of], lower

    def _names(self, lower: np.ndarray, starts: np.ndarray, stops: np.ndarray, hard: np.ndarray) -> np.ndarray:
        """Hash of every word."""
        up, down = self._powers_to(len(lower))
        sums = np.append(np.uint64(0), np.cumsum(_OF_BYTE[lower] * up[: len(lower)], dtype=np.uint64))
        names = (sums[stops] - sums[starts]) * down[starts]
        names ^= names >> np.uint64(29)
        names[hard] ^= _HARD_MARK
        for i in np.flatnonzero(stops - starts > _LONG).tolist():
            mark = b"\1" if hard[i] else b"\0"
            names[i] = int.from_bytes(blake2b(lower[starts[i] : stops[i]].tobytes() + mark, digest_size=8).digest(), "little")
        return names

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text, the end id last, as bytes of `dtype`."""
        ids, counts = self.encode_all(texts)
        raw, stops = ids.tobytes(), np.cumsum(counts) * self.dtype.itemsize
        return [raw[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist(), strict=False)]

    def encode_all(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id last; number of ids of each text)."""
        sizes = np.array([len(x) if x else 0 for x in texts], np.int64)
        raw = np.frombuffer(b" ".join([x or b"" for x in texts]) + b" ", np.uint8)
        starts, stops, hard, lower = self._cut(raw)
        if len(starts):
            distinct, first, inverse, counts = _distinct(self._names(lower, starts, stops, hard))
            place, new = self._places(distinct)
            if new.any() and len(self.keys) + int(new.sum()) > self.limit:
                # The half that was used most stays, and of it what fits.
                room = max(0, min(self.limit // 2, self.limit - int(new.sum())))
                used = np.argsort(self.uses, kind="stable")[::-1][:room]
                self._keep(np.sort(used))
                place, new = self._places(distinct)
            if new.any():
                which = first[new]
                held = lower.tobytes()
                cut = zip(starts[which].tolist(), stops[which].tolist(), strict=True)
                self._learn(distinct[new], [held[a:b] for a, b in cut], hard[which])
                place = np.searchsorted(self.keys, distinct)
            self.uses[place] += np.minimum(counts, 1 << 20).astype(np.int32)
            word_starts, word_lengths = self.starts[place][inverse], self.lengths[place][inverse]
        else:
            word_starts = word_lengths = np.zeros(0, np.int32)
        # The end of each text counts as one more word, kept behind all others.
        text_stops = np.cumsum(sizes + 1) - 1
        behind = np.searchsorted(starts, text_stops)
        all_starts = np.insert(word_starts, behind, len(self.flat))
        all_lengths = np.insert(word_lengths, behind, 1)
        ids = np.append(self.flat, np.array([self.end_id], self.dtype))[_runs(all_starts, all_lengths)]
        stops_at = np.cumsum(all_lengths, dtype=np.int64)[behind + np.arange(len(texts))]
        return ids, np.diff(stops_at, prepend=0)

    def _places(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        return place, ~known


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct names in order, a place of each, number of each place's name, how often each stands)."""
    order = np.argsort(names)
    ordered = names[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    inverse = np.empty(len(names), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    at = np.flatnonzero(new)
    return ordered[at], order[at], inverse, np.diff(np.append(at, len(names)))


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after the other."""
    stops = np.cumsum(lengths, dtype=np.int64)
    total = int(stops[-1]) if len(stops) else 0
    return np.repeat(starts - (stops - lengths), lengths) + np.arange(total)


def ids_column(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each count, over the memory of `ids`."""
    offsets = np.append(0, np.cumsum(counts, dtype=np.int64)) * ids.dtype.itemsize
    held = np.ascontiguousarray(ids)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(held)]
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_encoders: dict[tuple[str, int], WordEncoder] = {}


def worker_encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder of this worker, kept between tasks."""
    key = (path, end_id)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, end_id)
    return _encoders[key]
