"""Lines told apart within documents, and messages between chunks."""

import random
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tidewright.llm import packed, quality

SF_DIR = "/root/testdata/sf0.1"


def test_hidden_labels_gradient_matches_enumeration():
    rng = np.random.default_rng(3)
    field = quality.LineField(rng.normal(size=(quality.FEATURES, 2)), rng.normal(size=(2, 2)))
    lines = [[0, 3], [1], [2, 4], [0, 5]]
    chances = np.array([[0.9, 0.1], [0.9, 0.1], [0.05, 0.95], [0.05, 0.95]])
    every = [[i >> k & 1 for k in range(4)] for i in range(16)]

    def likelihood(at):
        local = at.scores(lines)

        def total(known):
            return np.logaddexp.reduce(
                [
                    sum(local[k][y] + (np.log(chances[k][y]) if known else 0) for k, y in enumerate(x))
                    + sum(at.steps[a][b] for a, b in zip(x, x[1:]))
                    for x in every
                ]
            )

        return total(True) - total(False)

    weights, steps = field.hidden_gradient(lines, chances)
    for got, of in ((weights, "weights"), (steps, "steps")):
        for place in ((0, 1), (1, 0)):
            values = []
            for eps in (1e-5, -1e-5):
                moved = quality.LineField(field.weights.copy(), field.steps.copy())
                getattr(moved, of)[place] += eps
                values.append(likelihood(moved))
            assert got[place] * 4 == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_planted_lines_are_found_in_documents_not_learned_from():
    rows = duckdb.sql(
        f"SELECT text, quality > 0 FROM '{SF_DIR}/documents.parquet' JOIN '{SF_DIR}/labels.parquet' USING (doc_id) "
        "WHERE text IS NOT NULL AND quality IS NOT NULL ORDER BY md5(doc_id::VARCHAR)"
    ).fetchall()
    learned, rest = rows[:2000], rows[2000:]
    field = quality.train([t.encode() for t, _ in learned], [g for _, g in learned])

    def decoded(text):
        lines, repeated = quality.document_lines(text)
        return field.decode([quality.line_features(*x) for x in zip(lines, repeated)]) if lines else []

    def passes(text):
        words = text.split()
        return len(words) >= 10 and 100 * quality.repeated_words([words])[0] <= 20 * len(words)

    judged = [(t.encode(), g) for t, g in rest if passes(t.encode())]
    junk = [x for t, g in judged if not g for x in t.split(b"\n") if x.strip()]
    rng = random.Random(2)
    found = missed = wrong = 0
    for text, good in judged:
        if not good or rng.random() < 0.6:
            continue
        lines = [(x, 1) for x in text.split(b"\n") if x.strip()]
        for _ in range(rng.randint(1, 3)):
            at, n = rng.randint(0, len(lines)), rng.randint(1, 3)
            start = rng.randrange(len(junk) - n)
            lines[at:at] = [(x, 0) for x in junk[start : start + n]]
        for (_, truth), label in zip(lines, decoded(b"\n".join(x for x, _ in lines)), strict=True):
            found += label == truth == 0
            missed += truth == 0 and label == 1
            wrong += truth == 1 and label == 0
    assert found / (found + wrong) >= 0.9 and found / (found + missed) >= 0.9
    # The field tells lines of one document apart, not only documents.
    assert sum(len(set(decoded(t))) == 2 for t, _ in judged) >= 50


def test_messages_follow_the_text():
    """Chunks times buckets for each byte of text do not grow from some size on."""
    per_gb = []
    for size in (3 << 30, 30 << 30, 1 << 40, 100 << 40):
        chunks = -(-size // packed.chunk_bytes(size))
        per_gb.append(chunks * chunks / (size / (1 << 30)))
    assert max(per_gb) <= 1.02 * min(per_gb)
    assert packed.chunk_bytes(500 << 20) == packed.CHUNK_BYTES and packed.chunk_bytes(100 << 40) < 512 << 20


def test_rows_between_chunks_grow_in_proportion(spark, monkeypatch):
    """With small chunks, twice the text gives twice the messages of the first exchange."""
    monkeypatch.setattr(packed, "CHUNK_BYTES", 4 << 10)
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=200))) for i in range(2400)]
    per_mb = []
    for n in (600, 2400):
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string")
        chunked, chunks = packed.chunked(docs, "doc_id", "text")
        size = sum(len(t) for _, t in rows[:n])
        assert chunked.select("chunk").distinct().count() <= chunks
        per_mb.append(chunks * chunks / size)
    assert per_mb[1] <= 1.2 * per_mb[0]
