"""Flattening, rules, routing, deduplication, dead letters and the stream."""

import json
from datetime import timedelta

import pytest
from conftest import NOW, ago
from pyspark.sql import functions as F

from tidewright.operators import dedupe, flatten, rules
from tidewright.plans import maintenance
from tidewright.schemas import EVENT_TABLE_SCHEMA
from tidewright.sources import batches, files, manifest, streams, tables
from tidewright.streaming import ingest


def iso(ts):
    return ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def event(event_id="1", event_type="PushEvent", payload=None, created=None, **changes):
    base = {
        "id": event_id,
        "type": event_type,
        "actor": {"id": 42, "login": "alice"},
        "repo": {"id": 99, "name": "alice/myrepo"},
        "payload": {"ref": "refs/heads/main", "commits": []} if payload is None else payload,
        "public": True,
        "created_at": iso(created or ago(minutes=5)),
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "absent"}


def raw(spark, *events):
    rows = [(e if isinstance(e, str) else json.dumps(e), i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "value string, position int")


def judged(spark, *events):
    rows = rules.validate(flatten.parse_raw(raw(spark, *events))).orderBy("position").collect()
    return [(r["error_reason"], r["metrics"]) for r in rows]


def flat(spark, *events, stamp=NOW):
    rows = flatten.flatten(flatten.parse_raw(raw(spark, *events)), F.lit(stamp))
    return flatten.with_partition(rows).orderBy("position").collect()


def test_flatten_fields(spark):
    (row,) = flat(spark, event())
    assert (row.actor_id, row.actor_login) == (42, "alice")
    assert (row.repo_id, row.repo_name, row.public) == (99, "alice/myrepo", True)
    assert row.event_id == "1" and row.event_type == "PushEvent"


def test_payload_text_decodes_to_the_same_object(spark):
    payload = {"z": 1, "a": {"b": [1, None, {"c": "é \" \\ \n"}]}, "f": 1.5}
    (row,) = flat(spark, event(payload=payload))
    assert json.loads(row.payload_json) == payload
    assert list(json.loads(row.payload_json)) == ["z", "a", "f"]


@pytest.mark.parametrize("payload", [{}, [], None, "absent"])
def test_falsy_payload_is_null(spark, payload):
    e = event()
    if payload == "absent":
        del e["payload"]
    else:
        e["payload"] = payload
    assert flat(spark, e)[0].payload_json is None


def test_missing_parts(spark):
    rows = flat(
        spark,
        event(actor="absent"),
        event(repo={}),
        event(repo={"name": None}),
        event(id=12345678901),
        event(id="absent"),
        event(actor={"id": "x1"}),
    )
    assert rows[0].actor_id is None and rows[0].actor_login is None
    assert rows[1].repo_name == "" and rows[2].repo_name is None
    assert rows[3].event_id == "12345678901" and rows[4].event_id == ""
    assert rows[5].actor_id is None


@pytest.mark.parametrize("bad", ["not-a-date", None, "absent", "", "2024", 17])
def test_bad_time_becomes_ingest_time(spark, bad):
    e = event()
    if bad == "absent":
        del e["created_at"]
    else:
        e["created_at"] = bad
    (row,) = flat(spark, e)
    assert row.created_at == row.ingested_at and not row.created_at_ok


def test_time_offsets(spark):
    rows = flat(
        spark,
        event(created_at="2026-03-10T12:00:00+02:00"),
        event(created_at="2026-03-10T10:00:00Z"),
        event(created_at="2026-03-10T10:00:00"),
    )
    assert len({r.created_at for r in rows}) == 1


def test_partition_routing(spark):
    rows = flat(
        spark,
        event(created=ago(hours=48)),
        event(created=ago(hours=23)),
        event(created=ago(hours=24)),
        event(created=ago(hours=24, seconds=1)),
        event(created=ago(hours=-3)),
    )
    assert [r.date for r in rows] == ["late", "2026-03-09", "2026-03-09", "late", "2026-03-10"]


def test_push_rules(spark):
    out = judged(
        spark,
        event(payload={"ref": "refs/heads/main", "commits": [{"sha": "a"}], "distinct_size": 7}),
        event(payload={"ref": "refs/heads/feature/foo"}),
        event(payload={"ref": "refs/tags/v1", "commits": None, "distinct_size": None}),
        event(payload={"commits": []}),
        event(id="absent"),
    )
    assert out[0][1] == {
        "commit_count": "1", "branch": "main", "is_default_branch": "true", "distinct_size": "7",
    }
    assert out[1][1] == {
        "commit_count": "0", "branch": "feature/foo", "is_default_branch": "false",
        "distinct_size": "0",
    }
    assert out[2][1]["branch"] == "v1" and out[2][1]["distinct_size"] is None
    assert out[3][0] == "[PushEvent] id='1': payload.ref is missing"
    assert out[4][0] == "[PushEvent] id='': required field missing: 'id'"


def test_pull_request_rules(spark):
    def pr(action="closed", number=5, **body):
        return event(event_type="PullRequestEvent",
                     payload={"action": action, "number": number, "pull_request": body})

    out = judged(
        spark, pr(merged=True, base={"ref": "main"}, additions=3), pr(merged=False),
        pr(action="opened", merged=True, draft=True), pr(action=""), pr(number=None),
        event(event_type="PullRequestEvent", payload={"action": "closed", "number": 1}),
    )
    assert out[0][1]["is_merged"] == "true" and out[0][1]["target_branch"] == "main"
    assert out[0][1]["additions"] == "3" and out[0][1]["deletions"] is None
    assert out[1][1]["is_merged"] == "false" and out[1][1]["target_branch"] == ""
    assert out[2][1]["is_merged"] == "false" and out[2][1]["is_draft"] == "true"
    assert "payload.action is missing" in out[3][0]
    assert "payload.number is missing" in out[4][0]
    assert out[5][0] is None and out[5][1]["is_merged"] == "false"


def test_issue_rules(spark):
    def issue(action="opened", **body):
        return event(event_type="IssuesEvent", payload={"action": action, "issue": body})

    out = judged(
        spark, issue("closed", number=4, labels=[{"name": "a"}, {"name": "b"}], comments=3),
        issue(number=4), issue(number=4, comments=None), issue(), issue(action=None, number=1),
    )
    assert out[0][1] == {
        "action": "closed", "issue_number": "4", "is_closed": "true", "label_count": "2",
        "comment_count": "3",
    }
    assert out[1][1]["comment_count"] == "0" and out[1][1]["label_count"] == "0"
    assert out[2][1]["comment_count"] is None
    assert "payload.issue.number is missing" in out[3][0]
    assert "payload.action is missing" in out[4][0]


def test_fork_rules(spark):
    def fork(forkee):
        return event(event_type="ForkEvent", payload={"forkee": forkee})

    out = judged(
        spark, fork({"full_name": "b/r", "owner": {"login": "b"}, "private": True}),
        fork({"full_name": "b/r"}), fork({}), fork(None), fork({"id": 1}),
    )
    assert out[0][1] == {"fork_full_name": "b/r", "fork_owner": "b", "is_private": "true"}
    assert out[1][1]["fork_owner"] == "" and out[1][1]["is_private"] == "false"
    assert "payload.forkee is missing" in out[2][0] and "payload.forkee is missing" in out[3][0]
    assert "payload.forkee.full_name is missing" in out[4][0]


def test_create_rules(spark):
    def create(**payload):
        return event(event_type="CreateEvent", payload=payload)

    names = ["v1.2.3", "2.0.0", "V1.2-beta", "hotfix-login", None]
    out = judged(
        spark, *[create(ref_type="tag", ref=n) for n in names],
        create(ref_type="branch", ref="v1.2.3"), create(ref_type="unknown_type"),
        create(ref="x"), create(ref_type=None, ref="x"),
    )
    assert [o[1]["is_semver_tag"] for o in out[:5]] == ["true", "true", "true", "false", "false"]
    assert out[4][1]["ref_name"] == ""
    assert out[5][1]["is_tag"] == "false" and out[5][1]["is_semver_tag"] == "false"
    assert out[6][0].endswith("payload.ref_type invalid or missing: 'unknown_type'")
    assert out[7][0].endswith("payload.ref_type invalid or missing: ''")
    assert out[8][0].endswith("payload.ref_type invalid or missing: None")


def test_watch_and_default_rules(spark):
    out = judged(
        spark,
        event(event_type="WatchEvent", payload={"action": "anything"}),
        event(event_type="WatchEvent", payload={}),
        event(event_type="GollumEvent", actor="absent", repo="absent"),
        event(event_type="GollumEvent", id=None),
        event(type="absent"),
    )
    assert out[0][0] is None and out[0][1] == {"action": "anything"}
    assert "payload.action is missing" in out[1][0]
    assert out[2] == (None, {})
    assert out[3][0] == "[default] id='': required field missing: 'id'"
    assert out[4][0] == "[default] id='1': required field missing: 'type'"


@pytest.mark.parametrize("key", ["id", "type", "actor", "repo"])
@pytest.mark.parametrize("kind", ["PushEvent", "WatchEvent", "IssuesEvent", "ForkEvent"])
def test_required_keys(spark, key, kind):
    ((reason, _),) = judged(spark, event(event_type=kind, **{key: None}))
    assert f"required field missing: '{key}'" in reason


def test_empty_values_are_not_missing(spark):
    ((reason, _),) = judged(spark, event(id="", actor={}, repo={}))
    assert reason is None


@pytest.mark.parametrize("text", ["{bad", "[1]", "", '{"a":1} x', '"s"', "null"])
def test_text_that_is_no_object(spark, text):
    ((reason, _),) = judged(spark, text)
    assert reason == "[default] id='': not a JSON object"


def test_null_repo_name_is_rejected(spark):
    ((reason, _),) = judged(spark, event(repo={"id": 1, "name": None}))
    assert reason.endswith("repo.name is null")


def test_custom_rule_and_skip(spark):
    table = dict(rules.RULES)
    rules.register(
        "GollumEvent",
        rules.TypeRules(
            fields=("pages",),
            checks=lambda pl, sub: [(pl.get("pages").isNull(), F.lit("no pages"))],
            metrics=lambda pl, sub: {"pages": pl.get("pages")},
            skip=lambda pl, sub: pl.get("pages") == "0",
        ),
        table,
    )
    texts = [event(event_type="GollumEvent", payload=p) for p in ({"pages": 2}, {"pages": 0}, {})]
    rows = rules.validate(flatten.parse_raw(raw(spark, *texts)), table)
    got = rows.orderBy("position").select("error_reason", "skipped").collect()
    assert [r.skipped for r in got] == [False, True, False]
    assert got[2].error_reason == "[GollumEvent] id='1': no pages"
    assert rules.accepted(rows).count() == 1


@pytest.fixture
def paths(tmp_path):
    root = str(tmp_path)
    return ingest.IngestPaths(f"{root}/e", f"{root}/dead", f"{root}/m", f"{root}/c")


def test_batch_dedupe_and_counts(spark, paths):
    first = raw(spark, event("a"), event("a", payload={"ref": "x"}), event("b"), "{bad",
                event("c", created=ago(hours=30)))
    counts = ingest.ingest_batch(first, paths, "s-0", stamp=NOW)
    assert counts == {
        "received": 5, "dead_lettered": 1, "skipped": 0, "duplicate_in_batch": 1,
        "already_stored": 0, "late": 1, "written": 3,
    }
    stored = {r.event_id: r for r in tables.read_events(spark, paths.events).collect()}
    assert json.loads(stored["a"].payload_json)["ref"] == "refs/heads/main"
    assert stored["c"].date == "late"
    again = ingest.ingest_batch(first, paths, "s-1", stamp=NOW)
    assert again["written"] == 0 and again["already_stored"] == 3
    mixed = ingest.ingest_batch(raw(spark, event("a"), event("d")), paths, "s-2", stamp=NOW)
    assert mixed["written"] == 1
    assert tables.read_events(spark, paths.events).count() == 4
    assert ingest.ingest_counters(spark, paths.counters).first()["written"] == 4


def test_replay_after_the_late_limit_is_not_stored_twice(spark, paths):
    e = event("x", created=ago(hours=20))
    bad = event("y", created_at="nope")
    ingest.ingest_batch(raw(spark, e, bad), paths, "s-0", stamp=NOW)
    later = NOW + timedelta(hours=30)
    counts = ingest.ingest_batch(raw(spark, e, bad), paths, "s-1", stamp=later)
    assert counts["late"] == 1 and counts["written"] == 0


def test_replayed_batch_keeps_one_dead_letter(spark, paths):
    rows = raw(spark, "{bad", event(id=None))
    for _ in range(2):
        ingest.ingest_batch(rows, paths, "s-0", stamp=NOW)
    ingest.ingest_batch(rows, paths, "s-1", stamp=NOW + timedelta(hours=1))
    dead = tables.read_dead_letters(spark, paths.dead_letters)
    assert dead.count() == 4
    newest = tables.latest_dead_letters(dead, 3).collect()
    assert len(newest) == 3 and newest[0].failed_at > newest[2].failed_at
    assert {r.raw_json for r in newest} >= {"{bad"}


def test_empty_batch_and_missing_tables(spark, paths):
    counts = ingest.ingest_batch(raw(spark).limit(0), paths, "s-0", stamp=NOW)
    assert counts["written"] == 0
    assert tables.read_events(spark, paths.events).count() == 0
    assert tables.read_dead_letters(spark, paths.dead_letters).count() == 0


def test_dedupe_with_one_dominant_key(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("o"),
    )
    rows = dedupe.first_per_key(hot.repartition(8), "k", "o")
    assert rows.count() == 20_001
    assert rows.where("k = 'hot'").first().o == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def write_lines(folder, name, *events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(
        "".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
    )


def test_stream_restart_and_redelivery(spark, paths, tmp_path):
    landing = tmp_path / "landing"
    now = ingest.utc_now()
    events = [event(str(i), created=now - timedelta(minutes=i)) for i in range(30)]
    write_lines(landing, "a.txt", *events[:20], "{bad")

    def run():
        ingest.start_ingest(
            streams.file_events(spark, str(landing), 1), paths, str(tmp_path / "cp"), "t",
            flush_seconds=None,
        ).awaitTermination()

    run()
    assert tables.read_events(spark, paths.events).count() == 20
    write_lines(landing, "b.txt", *events[10:])
    write_lines(landing, "c.txt", *events)
    run()
    table = tables.read_events(spark, paths.events)
    assert table.count() == 30 and table.select("event_id").distinct().count() == 30
    assert tables.read_dead_letters(spark, paths.dead_letters).count() == 1


def test_replay_of_a_batch_after_lost_checkpoint(spark, paths, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing, "a.txt", *[event(str(i), created=ingest.utc_now()) for i in range(5)], "x")
    for attempt in range(2):
        ingest.start_ingest(
            streams.file_events(spark, str(landing)), paths, str(tmp_path / f"cp{attempt}"), "t",
            flush_seconds=None,
        ).awaitTermination()
    assert tables.read_events(spark, paths.events).count() == 5
    assert tables.read_dead_letters(spark, paths.dead_letters).count() == 1


def test_jsonl_mirror_keeps_duplicates(spark, tmp_path):
    ingest.ingest_jsonl(raw(spark, event("a"), event("a"), event("é")), str(tmp_path / "j"), stamp=NOW)
    rows = tables.read_events_jsonl(spark, str(tmp_path / "j")).collect()
    assert sorted(r.event_id for r in rows) == ["a", "a", "é"]
    assert {r.created_at for r in rows} == {ago(minutes=5).replace(tzinfo=None)}
    assert "é" in "".join(p.read_text() for p in (tmp_path / "j").rglob("*.json"))


def test_compaction(spark, paths, tmp_path):
    for batch in range(3):
        rows = [event(f"{batch}-{i}") for i in range(4)]
        ingest.ingest_batch(raw(spark, *rows), paths, f"s-{batch}", stamp=NOW)
    ingest.ingest_batch(raw(spark, event("old", created=ago(hours=90))), paths, "s-3", stamp=NOW)
    before = {f.path for f in maintenance.live_files(spark, paths.events)}
    summary = {r.partition: r for r in maintenance.compact(spark, paths.events).collect()}
    day, late = summary["date=2026-03-10"], summary["date=late"]
    assert (day.skipped, day.files_before, day.files_after, day.rows) == (False, 3, 1, 12)
    assert (late.skipped, late.files_before, late.rows, late.output_paths) == (True, 1, 0, None)
    after = {f.path for f in maintenance.live_files(spark, paths.events)}
    assert len(after) == 2 and len(after & before) == 1
    assert len(files.data_files(spark, paths.events)) == 1  # the merged originals are gone
    spark.catalog.clearCache()
    assert tables.read_events(spark, paths.events).count() == 13
    assert maintenance.partitions(spark, paths.events) == ["date=2026-03-10", "date=late"]
    second = maintenance.compaction_totals(maintenance.compact(spark, paths.events)).first()
    assert (second.compacted, second.skipped, second.total_rows) == (0, 2, 0)


def test_compaction_cuts_a_large_partition(spark, tmp_path):
    path = str(tmp_path / "big")
    rows = spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.lit("PushEvent").alias("event_type"), F.lit("r").alias("repo_name"),
        F.lit(NOW).alias("created_at"), F.lit(NOW).alias("ingested_at"),
        F.lit("2026-03-10").alias("date"),
    )
    rows.repartition(6).write.partitionBy("date").parquet(path)
    (row,) = maintenance.compact(spark, path, target_bytes=500_000).collect()
    assert row.files_after > 1 and row.rows == 40_000
    assert tables.read_events(spark, path).select("event_id").distinct().count() == 40_000


def test_readers_see_each_row_once_while_a_compaction_runs(spark, paths, monkeypatch):
    for batch in range(2):
        ingest.ingest_batch(raw(spark, *[event(f"{batch}-{i}") for i in range(4)]), paths, f"s-{batch}", stamp=NOW)
    seen = []

    def count(*_):
        spark.catalog.clearCache()
        seen.append(tables.read_events(spark, paths.events).count())

    def failing(*_):
        count()
        raise OSError("killed")

    real = manifest.commit

    def watched(*args):
        count()
        real(*args)
        count()

    # Before and after the switch, and where the deletion of the originals fails.
    monkeypatch.setattr(manifest, "commit", watched)
    monkeypatch.setattr(maintenance, "delete", failing)
    with pytest.raises(OSError):
        maintenance.compact(spark, paths.events)
    monkeypatch.undo()
    assert seen == [8, 8, 8]
    assert len(files.data_files(spark, paths.events)) == 2  # originals wait for deletion
    # What arrives meanwhile stays, and the next run tidies up and merges once more.
    ingest.ingest_batch(raw(spark, event("0-0"), event("new")), paths, "s-2", stamp=NOW)
    ingest.ingest_batch(raw(spark, event("newer")), paths, "s-3", stamp=NOW)
    (row,) = maintenance.compact(spark, paths.events).collect()
    assert (row.files_before, row.files_after, row.rows) == (3, 1, 10)
    assert len(maintenance.live_files(spark, paths.events)) == 1
    assert tables.read_events(spark, paths.events).select("event_id").distinct().count() == 10
    assert files.data_files(spark, paths.events) == []
    assert tables.read_newest_events(spark, paths.events).count() == 10
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != "536870912"


def test_two_compactions_at_once_do_not_both_win(spark, paths):
    ingest.ingest_batch(raw(spark, event("a")), paths, "s-0", stamp=NOW)
    known = manifest.state(spark, paths.events)
    manifest.commit(spark, paths.events, known.after("one", []))
    with pytest.raises(RuntimeError):
        manifest.commit(spark, paths.events, known.after("two", []))


def test_partition_files_come_from_the_table(spark, paths):
    for batch in range(3):
        ingest.ingest_batch(raw(spark, event(f"{batch}")), paths, f"s-{batch}", stamp=NOW)
    ingest.ingest_batch(raw(spark, event("old", created=ago(hours=90))), paths, "s-3", stamp=NOW)
    want = {"date=2026-03-10": (3, 3), "date=late": (1, 1)}
    assert {r.partition: (r.files, r.rows) for r in maintenance.partition_files(spark, paths.events).collect()} == want
    maintenance.compact(spark, paths.events)
    want["date=2026-03-10"] = (1, 3)
    assert {r.partition: (r.files, r.rows) for r in maintenance.partition_files(spark, paths.events).collect()} == want
    assert maintenance.partition_files(spark, paths.events + "-none").count() == 0


def test_rolled_batches_are_recognised(spark, paths, monkeypatch):
    def send(i):
        ingest.ingest_batch(raw(spark, event(f"e{i}"), "not json", event("", created=ago(days=i))), paths, f"s-{i}", stamp=NOW)

    for i in range(4):
        send(i)

    def state():
        spark.catalog.clearCache()
        dead = sorted(tuple(r) for r in tables.read_dead_letters(spark, paths.dead_letters).collect())
        metrics = sorted(str(tuple(r)) for r in tables.read_batches(spark, paths.metrics, ingest.METRICS_SCHEMA).collect())
        return dead, metrics, ingest.ingest_counters(spark, paths.counters).first()

    before = state()
    assert len(before[0]) >= 4
    # A crash between the switch and the deletion leaves nothing twice.
    monkeypatch.setattr(batches, "delete", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        ingest.roll_up_batches(spark, paths, unchanged_hours=0)
    monkeypatch.undo()
    assert state() == before
    assert ingest.roll_up_batches(spark, paths, unchanged_hours=24)["metrics"] == 0
    ingest.roll_up_batches(spark, paths, unchanged_hours=0)
    assert state() == before
    for table in (paths.dead_letters, paths.metrics, paths.counters):
        assert files.data_files(spark, table) == []
        assert len(files.data_files(spark, f"{table}/_rolled")) == 1
        assert batches.is_rolled(spark, table, "s-1") and not batches.is_rolled(spark, table, "s-9")
    # Replaying sealed batches adds nothing; new ones are written beside and merged later.
    send(1)
    assert state() == before
    send(5)
    assert len(state()[0]) > len(before[0])
    send(6)
    after = state()
    assert ingest.roll_up_batches(spark, paths, unchanged_hours=0)["dead_letters"] == 2
    assert state() == after and files.data_files(spark, paths.dead_letters) == []


def test_compaction_of_some_dates_leaves_the_others(spark, tmp_path):
    # One task writes files of one name into every date.
    path = str(tmp_path / "dates")
    for load in range(2):
        days = [event(f"{load}-{i}", created=ago(days=i)) for i in range(4)]
        rows = flatten.with_partition(flatten.flatten(flatten.parse_raw(raw(spark, *days)), F.lit(NOW)), 1000)
        flatten.event_columns(rows, "date").coalesce(1).write.mode("append").partitionBy("date").parquet(path)
    chosen = ["date=2026-03-09", "date=2026-03-08"]
    assert {r.partition for r in maintenance.compact(spark, path, only=chosen).collect()} == set(chosen)
    assert tables.read_events(spark, path).groupBy("date").count().where("count = 2").count() == 4
    assert len(maintenance.live_files(spark, path)) == 6
    assert maintenance.partitions(spark, path) == [f"date=2026-03-{d:02}" for d in (7, 8, 9, 10)]


def test_compact_missing_table(spark, tmp_path):
    assert maintenance.compact(spark, str(tmp_path / "none")).count() == 0


def test_replay_dead_letters(spark, paths, tmp_path):
    ingest.ingest_batch(raw(spark, event("a", payload={}), "{bad"), paths, "s-0", stamp=NOW)
    fixed = ingest.IngestPaths(paths.events, str(tmp_path / "dead2"))
    counts = maintenance.replay_dead_letters(spark, paths.dead_letters, fixed, "r-0", stamp=NOW)
    assert counts["received"] == 2 and counts["dead_lettered"] == 2


def test_lookback_prunes_partitions(spark, paths):
    from tidewright.functions.time_bounds import lookback, to_micros

    rows = [event(str(i), created=ago(hours=i)) for i in range(0, 60, 5)]
    ingest.ingest_batch(raw(spark, *rows), paths, "s-0", threshold_hours=40, stamp=NOW)
    table = tables.read_events(spark, paths.events)
    assert table.schema == EVENT_TABLE_SCHEMA or table.schema["date"].dataType.simpleString() == "string"
    recent = lookback(table, "created_at", to_micros(NOW), 60)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((date" in plan.replace("\n", " ")
    assert "GreaterThanOrEqual(created_at" in plan
    assert recent.count() == 1


def test_recent_feed_reads_back_as_far_as_needed(spark, paths):
    from tidewright.operators.activity import recent_events
    from tidewright.plans.feed import recent_feed

    rows = [event(str(i), created=ago(hours=i * 7)) for i in range(20)]
    rows.append(event("w", "WatchEvent", {"action": "started"}, ago(hours=90)))
    ingest.ingest_batch(raw(spark, *rows), paths, "s-0", threshold_hours=100, stamp=NOW)
    table = tables.read_events(spark, paths.events)
    for limit, kind in [(3, None), (15, None), (50, None), (2, "PushEvent"), (1, "WatchEvent"), (5, "X")]:
        got = recent_feed(spark, paths.events, limit, kind).collect()
        assert got == recent_events(table, limit, kind).collect()
    assert recent_feed(spark, paths.events + "-none").count() == 0


def test_counters_stand_after_a_failure_behind_the_events(spark, paths, monkeypatch):
    rows = raw(spark, event("a"), event("b"), event("a"), "{bad")
    first = ingest._replace_batch

    def failing(frame, path, batch):
        if path == paths.metrics:
            raise OSError("storage is gone")
        first(frame, path, batch)

    monkeypatch.setattr(ingest, "_replace_batch", failing)
    with pytest.raises(OSError):
        ingest.ingest_batch(rows, paths, "s-0", stamp=NOW)
    assert tables.read_events(spark, paths.events).count() == 2
    monkeypatch.undo()
    counts = ingest.ingest_batch(rows, paths, "s-0", stamp=NOW + timedelta(hours=1))
    total = ingest.ingest_counters(spark, paths.counters).first().asDict()
    assert counts == total == {
        "received": 4, "dead_lettered": 1, "skipped": 0, "duplicate_in_batch": 1,
        "already_stored": 0, "late": 0, "written": 2,
    }
    assert tables.read_events(spark, paths.events).count() == 2


def test_counters_of_a_batch_that_failed_before_the_events(spark, paths, monkeypatch):
    def failing(*_):
        raise OSError("storage is gone")

    monkeypatch.setattr(ingest, "append_events", failing)
    with pytest.raises(OSError):
        ingest.ingest_batch(raw(spark, event("a")), paths, "s-0", stamp=NOW)
    monkeypatch.undo()
    assert ingest.ingest_batch(raw(spark, event("a")), paths, "s-0", stamp=NOW)["written"] == 1
    # The same name with other rows is another batch.
    assert ingest.ingest_batch(raw(spark, event("a"), event("c")), paths, "s-0", stamp=NOW)["received"] == 2


def test_a_failing_dead_letter_table_does_not_stop_the_ingest(spark, paths, monkeypatch):
    def failing(*_):
        raise OSError("storage is gone")

    monkeypatch.setattr(ingest, "write_dead_letters", failing)
    counts = ingest.ingest_batch(raw(spark, event("a"), "{bad"), paths, "s-0", stamp=NOW)
    assert counts["written"] == 1 and counts["dead_lettered"] == 1
    assert ingest.ingest_counters(spark, paths.counters).first().dead_lettered == 1


def test_dead_letters_wait_beside_the_events(spark, paths, monkeypatch):
    def failing(*_):
        raise OSError("storage is gone")

    def reasons():
        return tables.read_dead_letters(spark, paths.dead_letters).groupBy("ingest_batch").count().collect()

    monkeypatch.setattr(ingest, "write_dead_letters", failing)
    for name in ("s-0", "s 1"):
        ingest.ingest_batch(raw(spark, event(name), "{bad", "{worse"), paths, name, stamp=NOW)
    for late in (ingest.deliver_dead_letters, ingest.roll_up_batches):
        with pytest.raises(OSError):
            late(spark, paths)
    with pytest.raises(OSError):
        maintenance.replay_dead_letters(spark, paths.undelivered, paths, "r-0", stamp=NOW)
    monkeypatch.undo()
    assert reasons() == [] and len(files.folders(spark, paths.undelivered, 1)) == 3
    # A batch that runs again does not need what it left there; the next one takes the others along.
    ingest.ingest_batch(raw(spark, event("s-0"), "{bad", "{worse"), paths, "s-0", stamp=NOW)
    ingest.ingest_batch(raw(spark, event("b"), "{bad"), paths, "s-2", stamp=NOW)
    assert {tuple(r) for r in reasons()} == {("s-0", 2), ("s 1", 2), ("r-0", 4), ("s-2", 1)}
    assert files.folders(spark, paths.undelivered, 1) == [] and ingest.deliver_dead_letters(spark, paths) == 0
    assert tables.read_events(spark, paths.events).count() == 3


def test_a_batch_fails_when_its_dead_letters_can_wait_nowhere(spark, paths, monkeypatch):
    first = ingest._replace_batch

    def failing(frame, path, batch):
        if path in (paths.dead_letters, paths.undelivered):
            raise OSError("storage is gone")
        first(frame, path, batch)

    monkeypatch.setattr(ingest, "write_dead_letters", failing)
    monkeypatch.setattr(ingest, "_replace_batch", failing)
    with pytest.raises(OSError):
        ingest.ingest_batch(raw(spark, event("a"), "{bad"), paths, "s-0", stamp=NOW)
    assert tables.read_events(spark, paths.events).count() == 1


def test_held_batches_are_not_compressed(spark, paths, monkeypatch):
    key, seen, first = "spark.sql.inMemoryColumnarStorage.compressed", [], ingest.first_per_key
    before = spark.conf.get(key)
    monkeypatch.setattr(ingest, "first_per_key", lambda *a: (seen.append(spark.conf.get(key)), first(*a))[1])
    counts = ingest.ingest_batch(raw(spark, event("a"), event("a"), event("b")), paths, "b-0", stamp=NOW)
    assert (counts["written"], counts["duplicate_in_batch"]) == (2, 1)
    assert seen == ["false"] and spark.conf.get(key) == before


def test_a_small_batch_is_held_in_few_tasks(spark, paths, monkeypatch):
    key, found = "spark.sql.shuffle.partitions", []
    before, write = spark.conf.get(key), ingest.append_events

    def watched(rows, path):
        found.append(rows.rdd.getNumPartitions())
        write(rows, path)

    monkeypatch.setattr(ingest, "append_events", watched)
    spark.conf.set(key, "60")
    try:
        ingest.ingest_batch(raw(spark, *(event(str(i)) for i in range(40))), paths, "s-0", stamp=NOW)
    finally:
        spark.conf.set(key, before)
    assert found[0] < 20
    assert tables.read_events(spark, paths.events).count() == 40
    assert spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning") == "false"


def test_undated_events_are_recognised_at_any_distance(spark, paths):
    bad = [event("y", created_at="nope"), event("z")]
    ingest.ingest_batch(raw(spark, *bad), paths, "s-0", stamp=NOW)
    for days in (1, 90, 800):
        counts = ingest.ingest_batch(raw(spark, *bad), paths, f"s-{days}", stamp=NOW + timedelta(days=days))
        assert counts["written"] == 0 and counts["already_stored"] == 2
    assert tables.read_events(spark, paths.events).count() == 2


def test_undated_events_of_a_table_without_an_index(spark, paths):
    ingest.ingest_batch(raw(spark, event("y", created_at="nope")), paths, "s-0", stamp=NOW)
    files.delete(spark, paths.undated)
    counts = ingest.ingest_batch(
        raw(spark, event("y", created_at="nope")), paths, "s-1", stamp=NOW + timedelta(days=50)
    )
    assert counts["written"] == 0


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id")).write.parquet(path)
    # A held batch, as in the ingest: its size is known when the join is planned.
    new = spark.createDataFrame([(str(i),) for i in range(100)], "event_id string").persist()
    new.count()
    found = dedupe.known_ids(new, spark.read.parquet(path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The only exchange by key is the one of the few repeated ids.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")


def test_late_threshold_is_noted_once_and_only_for_whole_tables(spark, paths, tmp_path):
    assert tables.late_hours(spark, paths.events) is None
    for hours, want in ((24, 24), (48, 48), (24, 48)):
        tables.remember_late_hours(spark, paths.events, hours)
        assert tables.late_hours(spark, paths.events) == want
    old = str(tmp_path / "old")
    spark.createDataFrame([("1", "late")], "event_id string, date string").write.partitionBy("date").parquet(old)
    tables.remember_late_hours(spark, old, 24)
    assert tables.late_hours(spark, old) is None


def test_many_days_become_a_range(spark):
    stored = spark.createDataFrame([("2020-01-01",), ("2024-06-01",), ("late",)], "date string").withColumn(
        "created_at", F.lit(NOW)
    )
    days = [f"20{y}-{m:02}-{d:02}" for y in (22, 23, 24) for m in range(1, 13) for d in range(1, 29)]
    span = {"days": days, "low": None, "high": None}
    assert [r.date for r in dedupe.stored_candidates(stored, span).collect()] == ["2024-06-01"]


def test_lag_and_feed_prune_dates(spark, paths):
    from tidewright.functions.time_bounds import to_micros
    from tidewright.operators import activity
    from tidewright.streaming import refresh

    rows = [event(str(i), created=ago(hours=i)) for i in range(0, 60, 5)]
    for i, e in enumerate(rows):
        ingest.ingest_batch(raw(spark, e), paths, f"s-{i}", threshold_hours=40, stamp=ago(hours=i * 5))
    table = tables.read_events(spark, paths.events)
    lag = activity.lag_stats(table, 60, to_micros(NOW), late_hours=40)
    assert "PartitionFilters: [((date" in lag._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    assert lag.first() == activity.lag_stats(table, 60, to_micros(NOW)).first()
    assert tables.late_hours(spark, paths.events) == 40
    found = refresh.metric_tables(spark, paths.events, to_micros(NOW), 60)
    # The threshold is noted with the table, so the lag prunes without being told.
    assert "PartitionFilters: [((date" in found["lag"]._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    plan = found["recent"]._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    assert "PartitionFilters: [((date" in plan or found["recent"].count() == len(rows)
    out = paths.events + "-metrics"
    for _ in range(2):
        refresh.refresh_metrics(spark, paths.events, out, NOW, late_hours=40)
    assert spark.read.parquet(f"{out}/lag").count() == 1
    assert files.partition_names(spark, out) == []
