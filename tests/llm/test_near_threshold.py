"""The near-duplicate stage against brute force at 0.8, with links between 0.80 and 0.85 and very short texts."""

import random
from math import comb

import pytest

import corpus_pipeline
from tidewright.llm import near_duplicates


def _shingles(text):
    words = text.split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def _least(texts, percent):
    """Smallest linked id of every id."""
    sets = {i: _shingles(t) for i, t in texts.items()}
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if low[b] < low[a] and 100 * len(x & y) >= percent * len(x | y):
                    low[a], changed = low[b], True
    return low


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]

    found = {}
    for k in range(30):
        base = words(200)
        found[10 * k] = " ".join(base)
        # 4 scattered words leave 176 of 216 shingles, 5 leave 171 of 221.
        for changed, i in ((4, 1), (5, 2)):
            copy = list(base)
            for at in range(changed):
                copy[10 + 30 * at] = f"changed{k}x{changed}x{at}"
            found[10 * k + i] = " ".join(copy)
        # Four shingles of five: 0.8.
        short = words(9)
        found[10 * k + 5], found[10 * k + 6] = " ".join(short[:8]), " ".join(short)
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).cache()


def test_stage_links_from_four_fifths_on(spark, docs, texts):
    low = _least(texts, 80)
    assert sum(low[i] != i for i in texts) == 60
    kept = corpus_pipeline.one_of_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in texts if low[i] == i)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_at_both_thresholds(docs, texts, percent):
    got = near_duplicates.components(docs, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == _least(texts, percent)


@pytest.mark.parametrize("percent", [76, 80, 85, 90])
def test_chances_hold_at_every_threshold(percent):
    p, k = percent / 100, near_duplicates.K
    least = near_duplicates.least_estimate(percent) * k
    assert sum(comb(k, c) * p**c * (1 - p) ** (k - c) for c in range(k) if c < least) <= 1e-6
    assert near_duplicates.term_values(percent) <= k


def test_thresholds_beyond_the_sketches_are_refused(docs):
    with pytest.raises(ValueError):
        near_duplicates.components(docs, percent=60)
