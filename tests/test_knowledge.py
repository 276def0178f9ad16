"""Cases, vectors, neighbours, outcomes, evaluation and diagnosis."""

import hashlib
import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.functions.hash_vectors import cosine, hash_vector
from tidewright.functions.text import reverted_number
from tidewright.operators import cases as C
from tidewright.operators import evaluation, neighbor_index, neighbors, outcomes
from tidewright.plans import knowledge


def item(number, title, body=None, pr=True, labels=(), created="2026-01-10T00:00:00Z",
         closed="2026-01-12T12:00:00Z"):
    out = {"number": number, "title": title, "body": body, "html_url": f"u/{number}",
           "labels": [{"name": n} for n in labels], "created_at": created, "closed_at": closed}
    if pr:
        out["pull_request"] = {"url": "x"}
    return out


def build(spark, *items):
    rows = spark.createDataFrame(
        [(json.dumps(i), n) for n, i in enumerate(items)], "value string, position int")
    return C.build_cases(rows, "position")


ITEMS = [
    item(1, "Fix scheduler crash", "body one", labels=["Priority/critical", "bug"]),
    item(2, "Add feature gate", None, created="2026-01-10T00:00:00Z", closed="2026-01-10T12:00:00Z"),
    item(3, 'Revert "Fix scheduler crash"', "Reverts acme/widgets#1"),
    item(4, "Issue about nodes", "x" * 2000, pr=False, labels=["severity:high", "kind/bug"]),
    item(5, "Revert something unlinked", "no number", pr=False),
    item(6, "open one", "", closed=None),
]


def test_reverted_number(spark):
    rows = [("Revert x", "Reverts acme/widgets#123", 123), ("Revert #45", "nothing", 45),
            ("Revert y", None, None), ("Revert #9", "see REVERTS a-b/c.d#7 please", 7)]
    got = spark.createDataFrame(rows, "t string, b string, n int").select(
        "n", reverted_number(F.col("t"), F.col("b")).alias("r")).collect()
    assert all(r.n == r.r for r in got)


def test_cases(spark):
    got = {r.case_id: r for r in build(spark, *ITEMS).collect()}
    assert got["pr-1"].was_reverted and got["pr-1"].reverted_by == 3
    assert got["pr-3"].is_revert and got["pr-3"].reverts_number == 1
    assert not got["issue-5"].is_revert and got["issue-5"].reverts_number is None
    assert got["pr-1"].time_to_resolve_hours == 60.0 and got["pr-6"].time_to_resolve_hours is None
    assert len(got["issue-4"].body_snippet) == 1000 and got["pr-6"].body_snippet is None
    assert got["pr-1"].labels == ["Priority/critical", "bug"] and got["pr-2"].labels == []
    totals = C.build_totals(build(spark, *ITEMS)).first()
    assert (totals.total, totals.reverts, totals.linked) == (6, 1, 1)


def test_last_revert_wins(spark):
    rows = build(spark, item(100, "a"), item(105, "Revert #100"), item(103, "Revert #100"),
                 item(100, "issue with the same number", pr=False))
    got = {r.case_id: r for r in rows.collect()}
    assert got["pr-100"].reverted_by == 103 and not got["issue-100"].was_reverted


def test_items_are_parsed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(json.dumps(i), n) for n, i in enumerate(ITEMS)], "value string, position int")
    got = {r.case_id: r for r in C.build_cases(rows.mapInPandas(counted, rows.schema), "position").collect()}
    assert len(got) == len(ITEMS) and got["pr-1"].reverted_by == 3
    assert runs.value == len(ITEMS)


def test_case_text(spark):
    rows = spark.createDataFrame(
        [("A title", "A body"), ("A title", None), (" \t t", "b\n\n ")], "title string, body_snippet string")
    got = [r.t for r in rows.select(C.case_text().alias("t")).collect()]
    assert got == ["A title\nA body", "A title", "t\nb"]


def model_vector(text, dim):
    values, i = [], 0
    while len(values) < dim:
        digest = hashlib.sha256(f"{i}:{text}".encode()).digest()
        values += [w / 2**31 - 1.0 for w in struct.unpack(">8I", digest)]
        i += 1
    values = values[:dim]
    length = math.sqrt(sum(v * v for v in values)) or 1.0
    return [v / length for v in values]


@pytest.mark.parametrize("dim", [8, 13, 64])
def test_hash_vector(spark, dim):
    texts = ["hello", "", "naïve ✓", "a\nb"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.v for r in rows.select("t", hash_vector(F.col("t"), dim).alias("v")).collect()}
    for text in texts:
        assert np.allclose(got[text], model_vector(text, dim), atol=1e-12)
        assert math.isclose(sum(v * v for v in got[text]), 1.0)


def test_hash_vector_as_floats_and_without_text(spark):
    rows = spark.createDataFrame([("hello",), (None,)], "t string").select(
        "t", hash_vector(F.col("t"), 13).alias("v"), hash_vector(F.col("t"), 13, "float").alias("f")
    )
    known, missing = (rows.where(F.col("t").isNotNull() == x).first() for x in (True, False))
    assert known.f == np.asarray(known.v, dtype=np.float32).tolist()
    assert missing.v == missing.f == [None] * 13


def test_cases_are_dealt_out_and_embedded_once(spark):
    case = spark.range(0, 600, 1, 1).select(
        F.concat(F.lit("pr-"), "id").alias("case_id"), F.lit("a title").alias("title"), F.lit("text").alias("body_snippet")
    )
    rows = C.embed_cases(case, C.hash_embedder(16))
    dims = rows.select("case_id", F.explode("embedding")).groupBy("case_id").count()
    plan = dims._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("RepartitionByExpression [case_id")
    assert dims.where("count = 16").count() == 600


def test_cosine(spark):
    row = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])],
                                "a array<float>, b array<float>, z array<float>")
    got = row.select(cosine(F.col("a"), F.col("b")).alias("c"), cosine(F.col("a"), F.col("z")).alias("z")).first()
    assert got.c == pytest.approx(1 / math.sqrt(2)) and got.z is None


def brute(queries, corpus, k):
    q = np.array([v for _, v in queries], dtype=np.float32).astype(float)
    c = np.array([v for _, v in corpus], dtype=np.float32).astype(float)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    scores = np.round(unit(q) @ unit(c).T, 9)
    ids = np.array([i for i, _ in corpus])
    return {(queries[i][0], r + 1, int(ids[j]))
            for i in range(len(q)) for r, j in enumerate(np.lexsort((ids, -scores[i]))[:k])}


def vectors(seed, n, dim=12, clusters=6, same=0.34):
    """Clustered vectors with a third of them equal."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    out = centres[rng.integers(clusters, size=n)] + 0.1 * rng.normal(size=(n, dim))
    out[: int(n * same)] = out[0]
    return [(i, [float(x) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("n,k,seed", [(3, 5, 0), (400, 5, 1), (900, 10, 2)])
def test_neighbours_against_brute_force(spark, n, k, seed):
    corpus, asked = vectors(seed, n), vectors(seed + 10, 60)
    c = spark.createDataFrame(corpus, "case_id long, embedding array<float>")
    q = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    want = brute(asked, corpus, k)
    direct = neighbors.nearest(q, c, k).collect()
    assert {(r.query_id, r["rank"], r.case_id) for r in direct} == want
    blocks = neighbors.nearest(q, c, k, block_queries=7).collect()
    assert {(r.query_id, r["rank"], r.case_id) for r in blocks} == want
    both = neighbors.nearest(q, c, k, block_queries=25, block_rows=90).collect()
    assert {(r.query_id, r["rank"], r.case_id) for r in both} == want
    assert len(blocks) == len(direct) == len(want)


def test_the_query_side_is_computed_once(spark):
    rows = vectors(5, 150)
    c = spark.createDataFrame(rows, "case_id long, embedding array<float>")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    q = c.withColumnRenamed("case_id", "query_id").mapInPandas(counted, "query_id long, embedding array<float>")
    got = neighbors.nearest(q, c, 3, block_queries=10).collect()
    assert {(r.query_id, r["rank"], r.case_id) for r in got} == brute(rows, rows, 3)
    assert runs.value == 150


def test_blocks_are_groups_of_one_job(spark):
    rows = vectors(6, 200)
    c = spark.createDataFrame(rows, "case_id long, embedding array<float>")
    q = c.withColumnRenamed("case_id", "query_id")
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for limit in (100, 20):
        spark.sparkContext.setJobGroup(f"blocks-{limit}", "")
        neighbors.nearest(q, c, 3, block_queries=limit, block_rows=limit)
        jobs[limit] = len(tracker.getJobIdsForGroup(f"blocks-{limit}"))
    spark.sparkContext.setJobGroup("rest", "")
    # 9 or 169 groups, the same jobs.
    assert jobs[100] == jobs[20]
    plan = neighbors.block_join(q, c, 3, 4, 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "WindowGroupLimit" in plan
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_copies_of_small_blocks_do_not_grow_with_the_input():
    fitting = neighbors.MAX_BLOCK_BYTES // (8 * 64)
    copies = [
        neighbors.dealt_blocks(n, 200, fitting) + neighbors.dealt_blocks(n, 300, fitting)
        for n in (100, 2_000, 20_000, 200_000, 400_000)
    ]
    assert copies == [2, 22, 32, 32, 32]
    # Blocks still fit memory.
    assert all(1.25 * n / neighbors.dealt_blocks(n, 200, fitting) <= fitting for n in (500_000, 5_000_000))


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (7, 8), (40, 33), (64, 64)])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 1.0])
def test_places_of_few_cells(shape, share):
    mask = np.random.default_rng(1).random(shape) < share
    for cells in (mask, mask.T):
        assert all(np.array_equal(a, b) for a, b in zip(neighbors._places(cells), np.nonzero(cells)))


@pytest.mark.parametrize("order", ["near last", "near first", "all equal"])
def test_block_keeps_the_best_of_many_chunks(order):
    rng = np.random.default_rng(3)
    held = rng.normal(size=(5000, 24))
    if order == "all equal":
        held[:] = held[0]
    asked = held[::50] + (0.05 * rng.normal(size=(100, 24)) if order != "all equal" else 0)
    if order == "near last":
        held = held[np.argsort((held @ asked.T).max(axis=1))]
    elif order == "near first":
        held = held[np.argsort(-(held @ asked.T).max(axis=1))]
    rows = [(i, v) for i, v in enumerate(held.astype(np.float32).astype(float))]
    questions = [(i, v) for i, v in enumerate(asked.astype(np.float32).astype(float))]
    block = neighbors._Block(np.arange(100), neighbors._unit_rows([v for _, v in questions]), 5)
    for at in range(0, 5000, 1700):
        part = rows[at : at + 1700]
        block.meet(neighbors.pd.DataFrame({"case_id": [i for i, _ in part], "embedding": [v for _, v in part]}))
    got = block.best()
    ranks = got.groupby("query_id").cumcount() + 1
    assert set(zip(got["query_id"], ranks, got["case_id"], strict=True)) == brute(questions, rows, 5)


def recall(found, want):
    return len({(r.query_id, r.case_id) for r in found} & {(i, j) for i, _, j in want}) / len(want)


@pytest.mark.parametrize("kind", ["clustered", "scattered", "hot"])
def test_index_reaches_its_recall(spark, kind):
    rng = np.random.default_rng(11)
    if kind == "clustered":
        rows = vectors(3, 1500, dim=16, clusters=60, same=0.0)
    elif kind == "hot":
        rows = vectors(4, 900, dim=16, clusters=40)
    else:
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 24)))]
    asked = [r for r in rows if r[0] % 100 == 0]
    c = spark.createDataFrame(rows, "case_id long, embedding array<float>")
    q = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    index = neighbor_index.fit(c, 5, sample_rows=800)
    assert index.sample_recall >= neighbor_index.TARGET_RECALL
    found = index.nearest(q, c, 5).collect()
    want = brute(asked, rows, 5)
    assert all(r.query_id in dict(asked) for r in found) and {r["rank"] for r in found} == {1, 2, 3, 4, 5}
    if kind != "hot":
        assert recall(found, want) >= 0.9
    # Equal vectors share every bucket, and of those the ids decide as in the exact search.
    first = {(r.query_id, r.case_id) for r in found if r["rank"] == 1}
    assert first == {(i, j) for i, rank, j in want if rank == 1}
    # Small blocks split the large buckets and find the same.
    split = index.nearest(q, c, 5, block_queries=4, block_rows=50).collect()
    assert {tuple(r) for r in split} == {tuple(r) for r in found}
    if kind == "clustered":
        assert index.bits > 4


def test_index_of_little(spark):
    c = spark.createDataFrame(vectors(1, 4), "case_id long, embedding array<float>")
    q = c.withColumnRenamed("case_id", "query_id")
    for corpus in (c.limit(0), c.limit(1), c):
        index = neighbor_index.fit(corpus, 5)
        assert index.nearest(q.limit(0), corpus).count() == 0
        found = index.nearest(q, corpus, 5).collect()
        exact = neighbors.nearest(q, corpus, 5).collect()
        assert {(r.query_id, r["rank"], r.case_id) for r in found} == {(r.query_id, r["rank"], r.case_id) for r in exact}


def test_missing_vectors_are_an_error(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "case_id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="one length"):
        neighbors.nearest(q, c, 3)


def test_no_queries_and_empty_corpus(spark):
    c = spark.createDataFrame(vectors(1, 5), "case_id long, embedding array<float>")
    q = c.withColumnRenamed("case_id", "query_id")
    assert neighbors.nearest(q.limit(0), c).count() == 0
    assert neighbors.nearest(q, c.limit(0)).count() == 0


def corpus_of(spark, *items, dim=64):
    known = build(spark, *items)
    return C.searchable(known, C.embed_cases(known, C.hash_embedder(dim)))


def test_exact_text_is_rank_one(spark):
    corpus = corpus_of(spark, *ITEMS)
    queries = corpus.select(F.col("case_id").alias("query_id"), C.case_text().alias("t"))
    found = neighbors.search(C.hash_embedder(64)(queries, "t"), corpus, 5)
    top = found.where("rank = 1").collect()
    assert all(r.case_id == r.query_id and r.similarity_band == "high" for r in top) and len(top) == 6
    assert found.groupBy("query_id").count().where("count = 5").count() == 6


def test_batch_embedder_matches_native(spark):
    def model(texts):
        return [[float(len(t)), 1.0] for t in texts]

    rows = spark.createDataFrame([("a",), ("bbb",)], "t string")
    got = C.batch_embedder(model, 1)(rows, "t").collect()
    assert [r.embedding for r in got] == [[1.0, 1.0], [3.0, 1.0]]


def estimate(spark, ids, cases):
    rows = spark.createDataFrame([(i,) for i in ids], "case_id string")
    return outcomes.estimate_for_ids(cases, rows).first()


def test_outcomes(spark):
    cases = build(spark, *ITEMS)
    row = estimate(spark, ["pr-1", "pr-2", "issue-4"], cases)
    assert (row.sample_size, row.pr_count, row.revert_rate) == (3, 2, 0.5)
    assert row.severity_labels == ["priority/critical", "severity:high"]
    assert estimate(spark, ["pr-1", "pr-2"], cases).avg_time_to_resolve_hours == 36.0
    only = estimate(spark, ["issue-4", "issue-5"], cases)
    assert only.revert_rate is None and only.pr_count == 0
    for ids in ([], ["pr-999"]):
        none = estimate(spark, ids, cases)
        assert none.sample_size == 0 and none.revert_rate is None and none.severity_labels == []
    assert estimate(spark, ["pr-1", "pr-1"], cases).sample_size == 1


def test_parse_generated(spark):
    good = '{"summary": " s ", "suggested_actions": ["a", "b"], "confidence": "HIGH"}'
    texts = [good, f"```json\n{good}\n```", "garbage ", "{broken", '{"summary": "x"}', "see {\"summary\": 1} x }"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    got = [r.g for r in rows.select("i", outcomes.parse_generated(F.col("raw")).alias("g")).orderBy("i").collect()]
    assert got[0] == got[1] and got[0].summary == "s" and got[0].suggested_actions == ["a", "b"]
    assert got[0].confidence == "high"
    assert (got[2].summary, got[2].confidence, got[2].suggested_actions) == ("garbage", "low", [])
    assert got[3].summary == "{broken" and got[4].confidence == "low" and got[4].summary == "x"
    assert got[5].summary == texts[5].strip() and got[5].confidence == "low"


def test_evaluation(spark):
    def rated(ranks):
        rows = spark.createDataFrame([(r,) for r in ranks], "rank int")
        return evaluation.summary(rows).first()

    assert (rated([1, 1]).recall_at_1, rated([1, 1]).mrr) == (1.0, 1.0)
    assert (rated([None]).recall_at_5, rated([None]).mrr) == (0.0, 0.0)
    mixed = rated([1, None])
    assert (mixed.recall_at_1, mixed.mrr, mixed.n) == (0.5, 0.5, 2)
    assert rated([]).n == 0 and rated([]).mrr == 0.0
    assert rated([3, 4]).recall_at_3 == 0.5 and rated([3, 4]).mrr == round((1 / 3 + 1 / 4) / 2, 4)


def test_evaluate_end_to_end(spark):
    corpus = corpus_of(spark, *ITEMS)
    own = corpus.select(F.col("case_id").alias("query_id"), "embedding", F.col("case_id").alias("expected_case_id"))
    total, ranks = evaluation.evaluate(own, corpus)
    assert total.first().mrr == 1.0 and ranks.count() == 6
    pairs = evaluation.eval_set(build(spark, item(1, "x"), item(2, "A long enough title")))
    assert [r.expected_case_id for r in pairs.collect()] == ["pr-2"]


def test_diagnosis(spark):
    corpus = corpus_of(spark, *ITEMS)
    anomalies = spark.createDataFrame(
        [("a1", "CI spiked", "details"), ("a2", "Quiet", None)], "anomaly_id string, title string, description string")
    subjects = knowledge.anomaly_subjects(anomalies, C.hash_embedder(64))
    rows = {r.query_id: r for r in knowledge.diagnose(subjects, corpus, 3, F.lit("all calm")).collect()}
    one = rows["a1"]
    assert one.subject == "CI spiked\ndetails" and rows["a2"].subject == "Quiet"
    assert one.sample_size == 3 and len(one.similar_cases) == 3 and len(one.raw_evidence) == 4
    assert one.raw_evidence[0] == "[live pipeline snapshot]\nall calm"
    assert one.context.startswith("## Subject\nCI spiked\ndetails\n\n## Live pipeline evidence (")
    assert "\n\n---\n\n" in one.context
    empty = knowledge.diagnose(subjects, corpus.limit(0), 3).first()
    assert empty.sample_size == 0 and empty.evidence == "insufficient" and empty.raw_evidence == []
    assert empty.context.endswith("(no similar cases retrieved)")


def test_evidence_block(spark):
    corpus = corpus_of(spark, item(7, "T", None, labels=["a", "b"]), item(8, "U", "text"))
    q = corpus.where("case_id = 'pr-7'").select(F.lit(1).alias("query_id"), "embedding")
    blocks = outcomes.evidence_blocks(neighbors.search(q, corpus, 2)).first().blocks
    assert blocks[0] == "[pr-7] T\nlabels: a, b | reverted: no | similarity: high\n(no body)"
    assert blocks[1].startswith("[pr-8] U\nlabels: none | reverted: no | similarity: ")


def test_knowledge_base_files(spark, tmp_path):
    rows = spark.createDataFrame([(json.dumps(i), n) for n, i in enumerate(ITEMS)], "value string, position int")
    paths = str(tmp_path / "cases"), str(tmp_path / "emb")
    assert knowledge.load_corpus(spark, *paths).count() == 0
    for _ in range(2):
        knowledge.build_knowledge_base(rows, "position", *paths, C.hash_embedder(16))
    assert knowledge.load_corpus(spark, *paths).count() == 6


def test_lookup_with_a_dominating_key(spark):
    from tidewright.operators.skew import skew_safe_lookup

    facts = spark.range(9000).select(
        F.col("id").alias("q"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
    )
    dim = spark.range(-1, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = skew_safe_lookup(facts, dim, "k", 0.01).orderBy("q").collect()
    want = facts.join(dim, "k").select("k", "q", "v").orderBy("q").collect()
    assert [(r.k, r.q, r.v) for r in got] == [(r.k, r.q, r.v) for r in want]
