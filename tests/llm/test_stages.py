"""Pipeline stages and near duplicates on repeated ids, missing ids and clashing column names."""

import random

import pytest


import corpus_pipeline
from tidewright.llm import decontamination, language, near_duplicates


def _set(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def _rows():
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghijkl", k=rng.randint(3, 7))) for _ in range(900)]
    base = [rng.choices(words, k=120) for _ in range(9)]

    def near(text, k=1):
        text = list(text)
        for at in rng.sample(range(len(text)), k):
            text[at] = "changed"
        return " ".join(text)

    texts = [" ".join(b) for b in base]
    rows = [(i, t) for i, t in enumerate(texts)]
    # One id with two texts: near copies of both stand elsewhere.
    rows += [(50, texts[1]), (50, "quite another " + texts[2]), (51, near(base[2]))]
    # Rows that repeat, with and without an id; near copies without an id.
    rows += [(60, texts[3] + " tail")] * 3 + [(None, texts[4] + " end")] * 2 + [(None, near(base[4])), (None, near(base[5]))]
    rows += [(None, " ".join(rng.choices(words, k=60)))] * 3
    rows += [(70, " ".join(rng.choices(words, k=60))), (70, " ".join(rng.choices(words, k=60)))]
    rows += [(80, None), (80, None), (None, None), (81, ""), (82, " \n"), (83, "two words"), (84, "two words"), (85, "words two")]
    return rows


EXTRA = "DOC_ID string, `a.b` int, Score string, score_1 int, N_WORDS int, items string, text_hash int, key_id int, own_0 int"
GIVEN = ("x", 1, "y", 2, 3, "z", 4, 5, 6)


def _groups(rows):
    """Component of every row, by index, over all rows with words."""
    sets = [_set(t) for _, t in rows]
    low = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and low[j] < low[i]:
                    low[i], changed = low[j], True
    return {i: low[i] for i in range(len(rows)) if sets[i]}


def test_one_row_of_each_group_stays(spark):
    rows = _rows()
    given = [(i, t, "en", "s", 0, *GIVEN) for i, t in rows]
    docs = spark.createDataFrame(given, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(4)
    left = near_duplicates.without_near_duplicates(docs)
    assert left.columns == docs.columns
    plain = left.toDF(*[f"c{i}" for i in range(len(left.columns))]).select("c0", "c1")
    got = sorted(((r.c0, r.c1) for r in plain.collect()), key=str)
    groups = _groups(rows)
    best = {}
    for i, g in groups.items():
        number = rows[i][0]
        best.setdefault(g, []).append((number is None, number or 0))
    want_ids = sorted(str(min(x)) for x in best.values())
    kept = [r for r in got if _set(r[1])]
    assert len(kept) == len(best)
    assert sorted(str((n is None, n or 0)) for n, _ in kept) == want_ids
    # Of every group one row, and no two of the rest are linked.
    index = {(n, t): groups[i] for i, (n, t) in enumerate(rows) if i in groups}
    assert len({index[r] for r in kept}) == len(kept)
    assert len(got) - len(kept) == sum(not _set(t) for _, t in rows)
    assert near_duplicates.without_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_an_id_with_two_texts(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.components(docs, percent=80)
    linked = {r.component_id for r in got.where("doc_id = 51").collect()}
    assert linked == {2}
    assert {r.component_id for r in got.where("doc_id = 50").collect()} == {1, 2}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_stages_stand_any_column_names(spark, name, kind, tmp_path):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(i, t, None if i is None else "en", None if i is None else f"s{i % 2}", None, *GIVEN) for i, t in _rows()]
    columns = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    if kind == "empty":
        rows = []
    # The names clash in letter case, as tables of other systems may; Parquet keeps them.
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs = spark.createDataFrame(rows, columns).repartition(3)
        after = stage(spark, docs, "/root/testdata/sf0.001")
        assert name == "token_output" or after.columns == docs.columns
        n = after.count()
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    # Three languages cannot be learned from texts like these, so that stage may reject them all.
    assert n <= 3 * len(rows) and (n > 0 or kind == "empty" or name == "language")


@pytest.mark.parametrize("sensitive", ["true", "false"])
def test_added_names_never_clash(spark, sensitive):
    spark.conf.set("spark.sql.caseSensitive", sensitive)
    try:
        columns = "doc_id long, text string, lang string, `x.y` int, Score string, score_1 int, N_WORDS int, n_words_1 int, Items int"
        rows = [(i, f"some words of text {i}", "en", 1, "s", 2, 3, 4, 5) for i in range(5)]
        docs = spark.createDataFrame(rows, columns)
        found = language.identify(docs, language.fit(docs))
        assert found.columns[: len(docs.columns)] == docs.columns
        assert found.columns[-3:] == ["lang_pred", "score_2", "rejected"] and found.count() == 5
        assert language.recognised(docs, language.fit(docs)).columns == docs.columns
        items = spark.createDataFrame([(1, "words of text 3")], "item_id long, text string")
        hit = decontamination.contamination(docs, items)
        assert hit.columns[-4:] == ["n_words_2", "hit_starts", "hit_stops", "items_1"]
        clean = decontamination.clean_documents(docs, items)
        assert clean.columns == docs.columns and clean.count() == 4
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
