"""Flush by rows or by time, the Kafka options, and the rolled id index."""

import time

import pytest
from conftest import NOW, ago
from test_ingest import event, raw

from tidewright.sources import files, landed, streams, tables
from tidewright.streaming import ingest


@pytest.fixture
def paths(tmp_path):
    return ingest.IngestPaths(*(str(tmp_path / n) for n in ("events", "dead", "metrics", "counters")))


def wait(condition, seconds):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if condition():
            return True
        time.sleep(0.2)
    return False


def test_a_batch_starts_by_rows_or_by_time(spark, tmp_path):
    landing, batches = tmp_path / "landing", []
    landing.mkdir()

    def collect(rows, _):
        values = sorted(r.value for r in rows.collect())
        if values:  # Spark begins with a batch of nothing
            batches.append((time.monotonic(), values))

    def start():
        stream = streams.landed_events(spark, str(landing), flush_rows=5, flush_seconds=12)
        return (
            stream.writeStream.foreachBatch(collect)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(processingTime="500 milliseconds")
            .start()
        )

    query = start()
    try:
        began = time.monotonic()
        (landing / "a").write_text("1\n2\n")
        (landing / "_hidden").write_text("x\n" * 50)
        assert wait(lambda: batches, 60)
        # Two rows are too few: they came by time.
        assert batches[0][0] - began >= 12 and batches[0][1] == ["1", "2"]
        began = time.monotonic()
        (landing / "b").write_text("3\n4\n")
        (landing / "c").write_text("5\n6\n7")
        assert wait(lambda: len(batches) > 1, 30)
        # Five rows do not wait.
        assert batches[1][0] - began < 12 and batches[1][1] == ["3", "4", "5", "6", "7"]
    finally:
        query.stop()
    # A restart goes on behind what the checkpoint has.
    (landing / "d").write_text("8\n\n9\n10\n11\n")
    query = start()
    try:
        assert wait(lambda: len(batches) > 2, 60)
        assert batches[2][1] == ["", "10", "11", "8", "9"]
    finally:
        query.stop()
    assert len(batches) == 3


def test_reader_rules(tmp_path):
    reader = landed.LandedReader({"path": str(tmp_path / "none"), "flushRows": "2", "flushSeconds": "1000"})
    assert reader.latestOffset() == reader.initialOffset() == {"modified": -1, "path": ""}
    reader = landed.LandedReader({"path": tmp_path.as_uri(), "flushRows": "2", "flushSeconds": "1000"})
    (tmp_path / "a").write_text("one")
    assert reader.latestOffset() == reader.initialOffset()
    (tmp_path / "b").write_text("two\n")
    end = reader.latestOffset()
    parts = reader.partitions(reader.initialOffset(), end)
    assert [[r[0] for r in reader.read(p)] for p in parts] == [["one"], ["two"]]
    assert reader.partitions(end, end) == []


def test_landed_events_are_ingested(spark, paths, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    import json

    (landing / "a").write_text("\n".join(json.dumps(event(str(i))) for i in range(4)) + "\nnot json\n")
    query = ingest.start_ingest(
        streams.landed_events(spark, str(landing), flush_rows=3, flush_seconds=60),
        paths, str(tmp_path / "checkpoint"), "landed", flush_seconds=1, clock=lambda: NOW,
    )
    try:
        assert wait(lambda: files.has_data(spark, paths.metrics), 90)
    finally:
        query.stop()
    assert tables.read_events(spark, paths.events).count() == 4
    assert tables.read_dead_letters(spark, paths.dead_letters).count() == 1


def test_kafka_options():
    assert streams.kafka_options("b:9092", "events") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": "100",
        "maxTriggerDelay": "30s",
    }
    assert streams.kafka_options("b", "t", 7, 3, 1000)["maxOffsetsPerTrigger"] == "1000"


def test_the_id_index_is_rolled_up_and_still_knows(spark, paths):
    for i in range(3):
        undated = event(f"u{i}", created_at="unknown")
        ingest.ingest_batch(raw(spark, undated, event(f"e{i}")), paths, f"s-{i}", stamp=ago(days=9 - i))
    assert len(files.data_files(spark, paths.undated)) == 3
    assert ingest.roll_up_batches(spark, paths, unchanged_hours=0)["undated"] == 3
    assert files.data_files(spark, paths.undated) == []
    assert len(files.data_files(spark, f"{paths.undated}/_rolled")) == 1
    counts = ingest.ingest_batch(raw(spark, event("u0", created_at="unknown"), event("u9", created_at="?")), paths, "s-9", stamp=NOW)
    assert (counts["already_stored"], counts["written"]) == (1, 1)
    # An index is built from an older table once.
    files.delete(spark, paths.undated)
    for _ in range(2):
        counts = ingest.ingest_batch(raw(spark, event("u1", created_at="unknown")), paths, "s-10", stamp=NOW)
        assert counts["already_stored"] == 1
    assert {r.event_id for r in tables.read_batches(spark, paths.undated, ingest.UNDATED_SCHEMA).collect()} == {"u0", "u1", "u2", "u9"}
