"""One deployment end to end through its stored tables."""

import json
from datetime import timedelta

from conftest import NOW, ago
from test_ingest import event, raw
from test_knowledge import ITEMS
from test_metrics import runs

from tidewright.operators import cases as C
from tidewright.plans import knowledge
from tidewright.sources import sinks
from tidewright.streaming import ingest
from tidewright.workspace import Layout, Workspace


def test_workspace(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    space = Workspace(spark, layout, C.hash_embedder(32))
    assert space.event_counts(as_of=NOW).count() == 0
    assert space.detect(NOW).count() == 0 and space.capture_snapshot(NOW).count() == 0
    fresh = space.freshness().first()
    assert fresh.latest_event_at is None and not fresh.kb_ready

    pushes = [event(str(i), created=ago(hours=25 + i * 0.65)) for i in range(216)]
    pushes.append(event("now", created=ago(minutes=5)))
    pushes.append(event("bad", payload={}))
    ingest.ingest_batch(
        raw(spark, *pushes), ingest.IngestPaths(layout.events, layout.dead_letters), "w-0", stamp=NOW)
    sinks.overwrite(runs(spark, ("w", 6, 4, 2), ("w", 4, 36, 50)), layout.ci_runs)
    items = spark.createDataFrame([(json.dumps(i), n) for n, i in enumerate(ITEMS)], "value string, position int")
    knowledge.build_knowledge_base(items, "position", layout.cases, layout.embeddings, space.embed)

    assert space.event_counts(as_of=NOW).first().event_count == 1
    assert space.total().first().n == 217 and space.dead_letters().count() == 1
    assert space.recent(3).count() == 3
    found = {r.type for r in space.detect(NOW).collect()}
    assert found == {"ci_failure_spike", "commit_drought"}
    n = space.anomalies().count()
    assert space.detect(NOW + timedelta(minutes=3)).count() == n
    assert space.signal(NOW).where("scope = 'all'").first().ci_stability.status == "alert"
    assert space.capture_snapshot(NOW).first().title == "CI snapshot: 60% failure rate (10 runs)"
    assert space.anomalies().count() == n + 1
    fresh = space.freshness().first()
    assert fresh.latest_event_at == ago(minutes=5).replace(tzinfo=None) and fresh.case_count == 6

    one = space.anomalies().first().anomaly_id
    (row,) = space.diagnose(one, NOW).collect()
    assert row.sample_size == 5 and row.raw_evidence[0].startswith("[live pipeline snapshot]\nLive")
    assert "CI failure rate: 60% over 10 runs (baseline 10%)" in row.context
    questions = spark.createDataFrame([(1, " why? "), (2, "  ")], "query_id int, question string")
    (answer,) = space.ask(questions, NOW).collect()
    assert answer.subject == "why?" and len(answer.similar_cases) == 5
    texts = spark.createDataFrame([(1, "Fix scheduler crash\nbody one")], "query_id int, text string")
    best = space.search(texts, 1).first()
    assert best.case_id == "pr-1" and best.similarity_band == "high"
    index = space.neighbor_index()
    assert [tuple(r) for r in space.search(texts, 1, index).collect()] == [tuple(best)]
    assert space.lag(60, NOW).first().sample_size == 217
