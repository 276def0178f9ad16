"""Quality rules by line labelling: a linear-chain conditional random field.

Every line with a word gets binary features (symbols, capitals, digits, length,
repetition, closing punctuation); Viterbi decoding marks it content or
boilerplate. A document is kept when at least CONTENT_SHARE of its word
characters are in content lines and no base rule fails.

The field is trained on the driver over at most SAMPLE documents with a quality
label, chosen by hash. Labels of lines are hidden: a document's label only says
how likely its lines are boilerplate. Each step climbs the likelihood of that
knowledge, expectations with it less those without (forward-backward in numpy),
so single lines may go against their document. As most documents are of one
kind throughout, lines of the other kind are set into most training sequences;
from those the field learns how labels change.

Defined cases: null and empty texts have no words, fail the base rules and are
not kept; very long texts and lines are read whole; without labels all lines
are content; a tie between both labels is content; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import as_bytes, slices, space_words, tidy

SAMPLE = 2000
EPOCHS = 4
RATE = 0.2
# Chances of boilerplate and content on a line of a bad and of a good document, before its features are seen.
CHANCES = np.array([[0.9, 0.1], [0.05, 0.95]])
# Share of training sequences into which lines of the other kind are set, so that labels change within them.
SPLICED = 0.7
CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

_SPACES = b" \t\n\x0b\x0c\r"
_FOLLOWING = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_OTHER = bytes(b for b in range(33, 127) if not chr(b).isalnum())

FEATURES = 22
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_content_lines long, content_share double, base_failed boolean, kept boolean"
)


def _number(line: bytes, kind: bytes) -> int:
    return len(line) - len(line.translate(None, kind))


def line_features(line: bytes, repeated: bool) -> list[int]:
    """Numbers of the features that hold for a line with a word."""
    n = len(line.translate(None, _SPACES))
    words = line.count(b" ") + 1
    upper, lower = _number(line, _UPPER), _number(line, _LOWER)
    digits, symbols, other = _number(line, _DIGITS), _number(line, _SYMBOLS), _number(line, _OTHER)
    letters = n - digits - other
    found = [0, 1 if words < 3 else 2 if words < 10 else 3]
    if symbols:
        found.append(4)
    if symbols * 50 > n:
        found.append(5)
    if symbols * 10 > n:
        found.append(6)
    if upper * 5 > upper + lower:
        found.append(7)
    if upper * 2 > upper + lower:
        found.append(8)
    if digits * 10 > n:
        found.append(9)
    if other * 12 > n:
        found.append(10)
    if other * 5 > n:
        found.append(11)
    if letters * 2 < n:
        found.append(12)
    if repeated:
        found.append(13)
    if line[-1:] in (b":", b"-", b"|", b"\\"):
        found.append(14)
    if words < 8 and line[-1:] not in (b".", b"!", b"?", b",", b";"):
        found.append(15)
    if b"http" in line or b"www." in line or b"@" in line:
        found.append(16)
    if b"!!" in line:
        found.append(17)
    average = n / words
    found.append(18 if average < 3 else 19 if average < 9 else 20)
    if line[:1] in (b"-", b"|", b">", b"#"):
        found.append(21)
    return found


class LineField:
    """Two labels, 0 boilerplate and 1 content: feature weights and label-to-label weights."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    @classmethod
    def neutral(cls) -> LineField:
        return cls(np.zeros((FEATURES, 2)), np.zeros((2, 2)))

    def scores(self, lines: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum(axis=0) for f in lines])

    def decode(self, lines: list[list[int]]) -> list[int]:
        """Most likely labels by Viterbi decoding."""
        w, s = self.weights.tolist(), self.steps.tolist()
        a = b = 0.0
        back = []
        for k, found in enumerate(lines):
            x = y = 0.0
            for f in found:
                x += w[f][0]
                y += w[f][1]
            if k:
                # Ties prefer content.
                from_x = a + s[0][0] > b + s[1][0]
                from_y = a + s[0][1] > b + s[1][1]
                back.append((0 if from_x else 1, 0 if from_y else 1))
                a, b = (
                    (a + s[0][0] if from_x else b + s[1][0]) + x,
                    (a + s[0][1] if from_y else b + s[1][1]) + y,
                )
            else:
                a, b = x, y
        label = 0 if a > b else 1
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def _expected(self, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of each label on each line, and of each step summed over the lines, by forward-backward."""
        n = len(local)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = local[0]
        for k in range(1, n):
            ahead[k] = local[k] + np.logaddexp(ahead[k - 1, 0] + self.steps[0], ahead[k - 1, 1] + self.steps[1])
        for k in range(n - 2, -1, -1):
            nxt = local[k + 1] + behind[k + 1]
            behind[k] = np.logaddexp(self.steps[:, 0] + nxt[0], self.steps[:, 1] + nxt[1])
        total = np.logaddexp(*ahead[-1])
        pairs = ahead[:-1, :, None] + self.steps + (local + behind)[1:, None, :] - total
        return np.exp(ahead + behind - total), np.exp(pairs).sum(axis=0)

    def hidden_gradient(self, lines: list[list[int]], chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of what is known of hidden labels: before any feature, `chances` for each.

        Expectations with that knowledge less those without.
        """
        local = self.scores(lines)
        known, known_steps = self._expected(local + np.log(chances))
        free, free_steps = self._expected(local)
        weights = np.zeros_like(self.weights)
        for found, g in zip(lines, known - free, strict=True):
            weights[found] += g
        return weights / len(lines), (known_steps - free_steps) / len(lines)

    def gradient(self, lines: list[list[int]], label: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of `label` on every line; expectations by forward-backward."""
        at, steps = self._expected(self.scores(lines))
        at, steps = -at, -steps
        at[:, label] += 1
        weights = np.zeros_like(self.weights)
        for found, g in zip(lines, at, strict=True):
            weights[found] += g
        steps[label, label] += len(lines) - 1
        return weights / len(lines), steps / len(lines)


def document_lines(text: bytes) -> tuple[list[bytes], list[bool]]:
    """Lines with a word, and whether each equals an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen: set[bytes] = set()
    repeated = []
    for line in lines:
        repeated.append(line in seen)
        seen.add(line)
    return lines, repeated


def _spliced(lines, chances, other: tuple[list[list[int]], int], rng) -> tuple[list[list[int]], np.ndarray]:
    """The lines with one to three of another document of the other kind among them."""
    more, label = other
    n = min(len(more), int(rng.integers(1, 4)))
    start, at = int(rng.integers(len(more) - n + 1)), int(rng.integers(len(lines) + 1))
    own = np.repeat(CHANCES[label][None], n, axis=0)
    return lines[:at] + more[start : start + n] + lines[at:], np.concatenate([chances[:at], own, chances[at:]])


def train(texts: list[bytes], good: list[bool], seed: int = 5) -> LineField:
    field = LineField.neutral()
    rng = np.random.default_rng(seed)
    documents = []
    for text, label in zip(texts, good, strict=True):
        lines, repeated = document_lines(text)
        if lines:
            documents.append(([line_features(*x) for x in zip(lines, repeated, strict=True)], int(label)))
    kinds = [[k for k, (_, label) in enumerate(documents) if label == kind] for kind in (0, 1)]
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(documents)):
            lines, label = documents[i]
            chances = np.repeat(CHANCES[label][None], len(lines), axis=0)
            if kinds[1 - label] and rng.random() < SPLICED:
                lines, chances = _spliced(lines, chances, documents[rng.choice(kinds[1 - label])], rng)
            weights, steps = field.hidden_gradient(lines, chances)
            rate = RATE * (1 - epoch / EPOCHS)
            field.weights += rate * weights
            field.steps += rate * steps
    return field


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
    sample: int = SAMPLE,
) -> LineField:
    """A field from at most `sample` labelled documents, good and bad as they come."""
    rated = labels.where(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("of_id"), (F.col(quality_col) > 0).alias("good")
    )
    chosen = rated.orderBy(F.xxhash64("of_id", F.lit(23)), "of_id").limit(sample)
    # At most `sample` ids.
    held = docs.select(F.col(id_col).alias("of_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = held.join(F.broadcast(chosen), "of_id").collect()
    rows.sort(key=lambda r: (r.of_id, r.text, r.good))
    return train([r.text.encode() for r in rows], [r.good for r in rows])


def repeated_words(split: list[list[bytes]]) -> list[int]:
    """Per text, words inside a window of WINDOW words that is found twice or more in the text."""
    counts = np.array([len(w) for w in split], np.int64)
    total = int(counts.sum())
    if total < WINDOW + 1:
        return [0] * len(split)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for words in split for w in words), np.int64, total)
    rng = np.random.default_rng(11)
    value = rng.integers(0, 1 << 63, len(names), np.uint64)[ids] | np.uint64(1)
    owner = np.repeat(np.arange(len(split)), counts)
    hashed = np.zeros(total - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + value[k : total - WINDOW + 1 + k]
        hashed ^= hashed >> np.uint64(29)
    hashed = (hashed ^ (owner[: len(hashed)].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x94D049BB133111EB)
    inside = np.flatnonzero(owner[: len(hashed)] == owner[WINDOW - 1 :])
    own = hashed[inside]
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(total + 1, np.int64)
    starts = inside[twice]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(split)).tolist()


def _judge(field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked: LineField = field.value
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or b"" for t in as_bytes(batch.column("text"))]
                split = [space_words(t) for t in texts]
                repeats = repeated_words(split)
                rows = []
                for text, words, n_repeat in zip(texts, split, repeats, strict=True):
                    lines, repeated = document_lines(text)
                    labels = marked.decode([line_features(*x) for x in zip(lines, repeated, strict=True)]) if lines else []
                    sizes = [len(x.translate(None, _SPACES + _FOLLOWING)) for x in lines]
                    content = sum(n for n, label in zip(sizes, labels, strict=True) if label)
                    n = len(words)
                    failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n
                    share = content / sum(sizes) if sum(sizes) else 0.0
                    rows.append(
                        (
                            n, sum(sizes), _number(text, _SYMBOLS), sum(repeated), n_repeat, len(lines), sum(labels),
                            share, failed, not failed and share >= CONTENT_SHARE,
                        )
                    )
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 7 + [pa.float64(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    names=[x.split()[0] for x in SCHEMA.split(", ")],
                )

    return tidy(run)


def judge(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base figures, content share and verdict of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_judge(docs.sparkSession.sparkContext.broadcast(field)), SCHEMA)
