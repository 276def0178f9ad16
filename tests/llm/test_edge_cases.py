"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

import hashlib
import random
import tracemalloc
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import (
    byte_repeats,
    chat,
    decontamination,
    language,
    licenses,
    mixing,
    near_duplicates,
    quality,
    recompression,
    token_output,
)
from tidewright.llm.interval_expansion import repeat_classes

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside or add themselves.
    "n_words long, chunk long, hit_starts int, score string, copies int, mix_size int, node int, term int, rejected int"
)
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))


def _docs():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(25, 90))) for _ in range(12)]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20, base[0], "en", None), (21, base[1] + " one more", "en", "s1"), (22, base[0][5:], "de", "s2")]
    rows += [(30, None, "en", "s0"), (31, "", "de", "s0"), (32, " \n\t", None, "s1"), (33, "ünïcode ÄÖ", "de", "s1")]
    rows += [(34, LONG, "en", "s2"), (35, LONG, "en", "s2"), (36, "a " * 300, "en", "s0"), (37, "x" * 400, "en", None)]
    rows += [(None, base[2], "en", "s0"), (None, base[2], "en", "s0"), (None, None, None, None)]
    rows += [(40, base[3], "en", "s1"), (40, base[3], "en", "s1"), (41, "one", "en", "s1"), (42, "\0 \x85  é", "de", "s1")]
    return [(*r, None, 1, 2, 3, "x", 4, 5, 6, 7, 8) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_docs(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _in_order():
    rows = [(r[0], r[1] or "") for r in _docs()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))


def test_mix_meets_targets_and_passes_rows_through(docs, none):
    rows = mixing.pareto_mix(docs).collect()
    assert len(rows) == len(_docs())
    again = mixing.pareto_mix(docs.repartition(2)).collect()
    assert sorted(map(_key, rows)) == sorted(map(_key, again))
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        assert r.taken == r["size"] * r.copies <= 3 * r["size"]
    weights = mixing.cyclic_weights(list(sizes))
    assert list(weights) == ["s0", "s1", "s2", None] and list(weights.values()) == [5, 2, 1, 5]
    targets = mixing.fill_targets(sizes, weights)
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    assert all(targets[r.source] == pytest.approx(r.target) and sizes[r.source] == r.source_size for r in rows)
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in rows)
    assert mixing.pareto_mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_targets_share_what_is_above_the_cap():
    targets = mixing.fill_targets({"a": 10, "b": 1000, "c": 0}, {"a": 5, "b": 2, "c": 1})
    assert targets == {"a": 30.0, "b": 980.0, "c": 0.0}


def test_mix_near_target_on_many_documents(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 400), f"s{rng.randint(0, 4)}") for i in range(3000)]
    got = mixing.pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in got.groupBy("source", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= r.most
    # Larger documents are preferred: more copies a word than small ones, where there is a choice.
    assert got.where("copies > 0").count() < got.count()


def test_recompression_matches_brute_force(docs, none):
    seen, want = set(), []
    for number, text in _in_order():
        words = _words(text)
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in gone]
        want.append((number, len(words), len(gone), " ".join(kept)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in recompression.without_repeats(docs).collect()]
    assert sorted(map(_key, got)) == sorted(map(_key, want))
    assert recompression.without_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [1, 4, 4096])
def test_byte_repeats_match_brute_force(docs, none, hot):
    seen, want = set(), []
    for number, text in _in_order():
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        want.append((number, len(raw), int(gone.sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    found = byte_repeats.without_repeats(docs, hot=hot)
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in found.collect()]
    assert sorted(map(_key, got)) == sorted(map(_key, want))
    assert byte_repeats.without_repeats(none).count() == 0


def test_interval_expansion_matches_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(60):
        text = rng.integers(0, 1 + trial % 4, rng.integers(1, 90)).astype(np.uint8)
        least = int(rng.integers(1, 30))
        places, classes = repeat_classes(text, least)
        padded = bytes(text) + bytes(least)
        of = dict(zip(places.tolist(), classes.tolist(), strict=True))
        strings = {}
        for i in range(len(text)):
            assert strings.setdefault(padded[i : i + least], of[i]) == of[i]
        assert len(set(of.values())) == len(strings)


def test_wu_manber_matches_brute_force(spark, docs, none):
    texts = [r[1] for r in _docs()]
    items = [(1, " ".join(texts[0].split()[3:18])), (2, "one"), (3, "a a"), (4, ""), (5, None), (None, texts[2])]
    items += [(6, LONG[5000:9000]), (6, LONG[5000:9000]), (7, "ÜNÏCODE äö"), (8, "not here at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pairs = [("" if i is None else str(i), t.encode()) for i, t in items if t]
    found = decontamination.contamination(docs, benchmark)
    assert found.columns[: len(docs.columns)] == docs.columns
    n_words, starts, stops, named = found.columns[-4:]
    for row in found.collect():
        if row.text == LONG:
            assert set(row[named]) == {"6"}
            continue
        words = decontamination.folded_words((row.text or "").encode())
        hit, want = decontamination.brute_force(words, pairs)
        assert row[n_words] == len(words) and set(row[named]) == want
        assert {k for a, b in zip(row[starts], row[stops]) for k in range(a, b)} == hit
    # Small parts give the same result.
    whole = sorted(map(_key, found.select("doc_id", starts, stops, named).collect()))
    before, decontamination.PART_BYTES = decontamination.PART_BYTES, 600
    try:
        parts = decontamination.contamination(docs, benchmark).select("doc_id", starts, stops, named).collect()
    finally:
        decontamination.PART_BYTES = before
    assert sorted(map(_key, parts)) == whole
    assert decontamination.clean_documents(docs, benchmark).columns == docs.columns
    assert decontamination.contamination(none, benchmark).count() == 0
    assert decontamination.clean_documents(docs, benchmark.limit(0)).count() == docs.count()


def test_license_scan(spark, none):
    mit = licenses.TEMPLATES["mit"]
    rows = [
        (1, f"Intro.\n\n{mit.upper()}\n\nEnd CC BY cc-by"),
        (2, "All rights reserved. all RIGHTS\nreserved, the General Public License"),
        (3, None),
        (4, ""),
        (5, " ".join(mit.split()[:12])),
        (None, "cc by cc by"),
        (6, "acc by " * 40_000 + "cc by"),
        (6, "cc"),
        (7, "all rİghts reserved; Keep all rights reserved"),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_base string")
    got = {(r.doc_id, r.n_words): r for r in licenses.license_scan(docs).collect()}
    assert len(got) == len(rows)
    by = {k[0]: r for k, r in got.items()}
    assert by[1].labels == ["cc-by", "mit"] and by[1].n_base == 2 and by[1].score == 1.0
    assert (by[2].base_labels, by[2].n_base, by[2].first_word, by[2].last_word) == (["gpl", "reserved"], 3, 0, 7)
    assert by[3].n_words == by[4].n_words == 0 and by[3].first_word is None and by[3].labels == []
    assert by[5].labels == [] and by[5].score == 0
    assert by[None].n_base == 2 and by[None].last_word == 2
    assert got[6, 80_002].n_base == 1 and got[6, 80_002].first_word == 80_000 and got[6, 1].n_base == 0
    assert by[7].n_base == 1 and by[7].first_word == 4
    assert licenses.license_scan(none).count() == 0


def test_language(docs, none):
    model = language.fit(docs)
    found = language.identify(docs, model)
    assert found.columns[: len(docs.columns)] == docs.columns and found.count() == docs.count()
    pred, score, rejected = found.columns[-3:]
    for r in found.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r[pred] == "und") == (not letters) and 0 <= r[score] <= 1
        assert letters or r[rejected]
    empty = language.fit(none)
    assert {r[0] for r in language.identify(docs, empty).select(pred).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


def test_near_duplicates_match_brute_force(docs, none):
    rows = [(i, near(t)) for i, t in ((r[0], r[1]) for r in _docs())]
    ids = [i for i, _ in rows]
    low = {i: i for i in ids if i is not None}
    changed = True
    while changed:
        changed = False
        for a, x in rows:
            for b, y in rows:
                if a is None or b is None or not x or not y:
                    continue
                if 100 * len(x & y) >= 85 * len(x | y) and low[b] < low[a]:
                    low[a], changed = low[b], True
    got = near_duplicates.components(docs).collect()
    assert len(got) == len(rows)
    assert sorted(map(_key, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(
        map(_key, ((i, len(s), low.get(i)) for i, s in rows))
    )
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    left = near_duplicates.without_near_duplicates(docs)
    # The stage links rows without an id too; here those with words are copies of a row that has one.
    assert left.columns == docs.columns
    assert left.count() == sum(r.kept for r in got if r.doc_id is not None or r.n_shingles == 0)
    assert near_duplicates.components(none).count() == 0


def near(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in _words(text)]
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_many_near_copies_become_one_component(spark):
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(200)] = f"changed{i}"
        rows.append((i + 1, " ".join(words)))
    rows.append((1000, " ".join(base[:100] + ["other"] * 100)))
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.kept} == {1, 1000}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r.node: r.component for r in near_duplicates.connected(links).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90}


def test_quality_base_figures(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    field = quality.fit(docs, labels)
    got = quality.judge(docs, field).collect()
    want = []
    for row in _docs():
        text, words = row[1] or "", _words(row[1])
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts = {}
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
        inside = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 5)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if _words(line):
                again += line in seen
                seen.add(line)
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        want.append((row[0], len(words), sum(map(len, words)), symbols, again, len(inside), failed))
    figures = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    ]
    assert sorted(map(_key, figures)) == sorted(map(_key, want))
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.fit(docs, labels.limit(0)).decode([[0], [1]]) == [1, 1]
    assert quality.judge(none, field).count() == 0


def test_viterbi_and_gradient_match_enumeration():
    rng = np.random.default_rng(2)
    field = quality.LineField(rng.normal(size=(quality.FEATURES, 2)), rng.normal(size=(2, 2)))
    lines = [[0, 3], [1], [2, 4], [0, 5]]
    local = field.scores(lines)

    def score(labels):
        return sum(local[k][y] for k, y in enumerate(labels)) + sum(field.steps[a][b] for a, b in zip(labels, labels[1:]))

    every = [[i >> k & 1 for k in range(4)] for i in range(16)]
    assert field.decode(lines) == max(every, key=score)
    chance = np.exp([score(x) for x in every])
    chance /= chance.sum()
    weights, steps = field.gradient(lines, 1)
    expected = sum(p * sum(y for k, y in enumerate(x) if 0 in lines[k]) for p, x in zip(chance, every))
    assert weights[0, 1] * 4 == pytest.approx(2 - expected)
    both = sum(p * sum(a == b == 1 for a, b in zip(x, x[1:])) for p, x in zip(chance, every))
    assert steps[1, 1] * 4 == pytest.approx(3 - both)


def test_token_round_trip(docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_output.tokenizer_path())
    rows = sorted(_docs(), key=lambda r: (r[0] is not None, r[0] or 0))
    want = []
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids + [1]
        want.append((row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = token_output.encoded_documents(docs).orderBy("start").collect()
    assert sorted(map(_key, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in got))) == sorted(map(_key, want))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    given = [r.doc_id for r in got if r.doc_id is not None]
    assert given == sorted(given) and got[0].doc_id is None
    assert token_output.encoded_documents(none).count() == 0


def test_variable_length_coding():
    values = np.array([0, 1, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    for n in range(len(values) + 1):
        control, data = token_output.pack(values[:n])
        assert token_output.unpack(control, data, n).tolist() == values[:n].tolist()
        assert len(control) == -(-n // 4)


def test_special_strings_are_encoded_as_by_the_library():
    encoder = token_output.WordEncoder(token_output.tokenizer_path(), limit=5)
    texts = ["a<|endoftext|>b c\x01d \x01", "́e x y don't DON'T", "<|startoftext|>", "", "é é ΑΣ"] * 3
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids, encoder.dtype).tolist() == want


HARD = ["\\### x", "</turn>", "\\\\</turn>", "###", "####", "a\n</turn>\n### user\n", "ends \\", "", "\n", "\\###\\###"]


@pytest.mark.parametrize("role", ["user", "assistant", "", "a\nb", "x\\", "### </turn>"])
def test_chat_turns_round_trip(role):
    for text in HARD:
        segment, start, stop = chat.render_turn(role, text)
        assert chat.parse_turn(segment)[:2] == (role, text)
        assert chat.unescape(segment[start:stop]) == text
    assert chat.render_turn("user", "plain \\ text")[0] == "### user\nplain \\ text\n</turn>\n"


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, None, None), (2, None, "assistant", "x"), (2, 0, "user", None)]
    rows += [(3, 0, "user", "t"), (3, 0, "user", "t"), (None, 0, "assistant", "\\###"), (4, 0, "assistant", "z" * 200_000)]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\nb\n\n\n").hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 1, hashlib.sha256(b"b").hexdigest())
    assert got[3].n_turns == 2 and got[3].loss_chars == 0
    assert got[None].loss_sha256 == hashlib.sha256(b"\\###").hexdigest()
    assert got[4].loss_chars == 200_000
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_pipeline_stages_match_brute_force(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "token_output",
    ]
    benchmark = [
        (str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()
    ]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        path = str(tmp_path / f"{i}")
        stage(spark, docs, source).write.parquet(path)
        after = spark.read.parquet(path)
        if name == "token_output":
            assert after.count() == len(before)
            break
        assert after.columns == docs.columns
        kept = after.collect()
        if name == "language":
            named = language.identify(docs, language.fit(docs, learn_from=language.learnable()))
            assert {r.doc_id for r in kept} == {r.doc_id for r in named.where("not rejected").collect()}
            # The model of so few documents knows all but very short texts.
            gone = {r.doc_id for r in before} - {r.doc_id for r in kept}
            assert all(len(_words(r.text)) < 12 for r in before if r.doc_id in gone)
        if name == "near_duplicates":
            sets = {r.doc_id: near(r.text) for r in kept}
            ids = sorted(sets)
            assert not any(
                100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a in ids for b in ids if a < b and sets[a]
            )
        if name == "decontamination":
            want = {
                r.doc_id for r in before
                if not decontamination.brute_force(decontamination.folded_words((r.text or "").encode()), benchmark)[0]
            }
            assert {r.doc_id for r in kept} == want
        if name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.pareto_mix(docs).collect() if r.copies}
            counted = {}
            for r in kept:
                counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
            assert counted == copies
        docs = after


def test_language_is_right_on_documents_that_were_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.fit(docs, learn_from=language.learnable(), sample_per_language=150))
    right = found.where(language.held_out()).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97


def test_reading_tokens_back_takes_one_python_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    plan = token_output.encoded_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_scores_of_a_language_hold_little_beside_the_text():
    table = np.random.default_rng(3).random((1 << language.BUCKET_BITS, 4)).astype(np.float32)
    model = language.LanguageModel(list("abcd"), table, np.zeros(4, np.float32), 1.0, 0.0)
    texts = [bytes([97 + i % 26]) * (5000 * i % 90_001) for i in range(24)]
    want = [sum(table[x].sum(axis=0, dtype=np.float64) for x in language._buckets(np.frombuffer(b" " + t + b" ", np.uint8))) for t in texts]
    sizes = [sum(max(0, len(t) + 3 - n) for n in language.ORDERS) for t in texts]
    tracemalloc.start()
    got = language._scores(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, [w / n for w, n in zip(want, sizes, strict=True)])
    assert peak < 30 * sum(len(t) for t in texts)


def test_words_that_differ_in_case_or_marks_go_through_the_library_once():
    encoder = token_output.WordEncoder(token_output.tokenizer_path())
    merged, simple = [], encoder._simple
    encoder._simple = lambda pieces: simple(merged.extend(pieces) or pieces)
    texts = ["word Word word, (WORD) word. É é", "words; word; É, don't word's"]
    got = [ids for text in texts for ids in encoder.encode([text.encode()])]
    assert sorted(merged) == sorted(x.encode() for x in ["word", ",", "(", ")", ".", "é", "words", ";"])
    for text, ids in zip(texts, got, strict=True):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids, encoder.dtype).tolist() == want


@pytest.mark.parametrize("limit", [3, 1000])
def test_words_are_encoded_as_by_the_library(limit):
    encoder = token_output.WordEncoder(token_output.tokenizer_path(), limit=limit)
    rng = random.Random(limit)
    letters = "aAbZz09'.,<|>-_~éÉàÀßÿŸ×÷Ððıİ́  　ΑΣς漢字ñÑþÞ\x00\x85\x1c\U0001f600"
    made = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(600)]
    made += ["don't", "WE'LL", "x" * 300, "É" * 90, "<|endoftext|>", "a<|startoftext|>b", "Ã", "<|ENDOFTEXT|>"]
    texts = [rng.choice(" \n\t\r\x0b\x0c").join(rng.choices(made, k=rng.randint(0, 40))) for _ in range(60)] + [None, "", " "]
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        got = encoder.encode([None if t is None else t.encode() for t in part])
        for text, ids in zip(part, got, strict=True):
            want = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
            assert np.frombuffer(ids, encoder.dtype).tolist() == want
