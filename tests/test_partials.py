"""Hourly partial aggregates against recomputation from the events."""

import math
import random
from datetime import datetime, timezone

import pytest
from conftest import NOW, ago
from pyspark.sql import functions as F
from test_ingest import event, raw

from tidewright.functions.time_bounds import to_micros
from tidewright.operators import activity, hourly
from tidewright.sources import files, partials, tables
from tidewright.sources.batches import replace_batch
from tidewright.streaming import ingest, refresh


@pytest.fixture
def paths(tmp_path):
    return ingest.IngestPaths(
        *(str(tmp_path / n) for n in ("events", "dead", "metrics", "counters", "partials"))
    )


def batch(seed, n=40):
    rng = random.Random(seed)
    return [
        event(
            f"{seed}-{i}",
            rng.choice(["PushEvent", "WatchEvent"]),
            {"ref": "x", "action": "started"},
            created=ago(minutes=rng.randint(-20, 60 * 30)),
            actor={"id": 1, "login": f"a{rng.randint(0, 12)}"},
            repo={"id": 2, "name": f"r{rng.randint(0, 5)}"},
        )
        for i in range(n)
    ]


def same(spark, paths, minutes, at=NOW):
    got = refresh.metric_tables(spark, paths.events, to_micros(at), minutes, partials_path=paths.partials)
    want = refresh.metric_tables(spark, paths.events, to_micros(at), minutes)
    for name in ("event_counts", "top_entities", "lag", "recent"):
        assert [tuple(r) for r in got[name].collect()] == [tuple(r) for r in want[name].collect()], name
    return got


def test_refresh_from_partials_equals_recomputation(spark, paths):
    for seed in range(4):
        rows = batch(seed) + (batch(seed - 1)[:5] if seed else [])  # some come again
        ingest.ingest_batch(raw(spark, *rows), paths, f"s-{seed}", stamp=ago(minutes=30 * (3 - seed)))
    # Look-backs that begin inside an hour, on an hour, and before everything.
    for minutes, at in ((75, NOW), (60, NOW), (17, ago(minutes=29)), (60 * 40, NOW), (1, ago(hours=-30))):
        same(spark, paths, minutes, at)


def test_events_are_read_for_the_broken_hour_only(spark, paths):
    for day in range(4):
        rows = [event(f"{day}-{i}", created=ago(days=day, minutes=20 * i)) for i in range(6)]
        ingest.ingest_batch(raw(spark, *rows), paths, f"s-{day}", threshold_hours=1000, stamp=NOW)
    minutes = 2 * 24 * 60 + 25
    want = refresh.metric_tables(spark, paths.events, to_micros(NOW), minutes)["event_counts"].collect()
    for name in files.partition_names(spark, paths.events):
        if name != "date=2026-03-08":
            files.delete(spark, f"{paths.events}/{name}")
    spark.catalog.clearCache()
    got = refresh.metric_tables(spark, paths.events, to_micros(NOW), minutes, partials_path=paths.partials)
    assert [tuple(r) for r in got["event_counts"].collect()] == [tuple(r) for r in want]
    plan = got["event_counts"]._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    assert "(date" in plan and "<= 2026-03-08" in plan


@pytest.mark.parametrize("broken", ["append_events", "_replace_batch", "write_partials"])
def test_a_batch_that_runs_again_counts_once(spark, paths, monkeypatch, broken):
    ingest.ingest_batch(raw(spark, *batch(1)), paths, "s-1", stamp=NOW)
    real = getattr(ingest, broken)

    def failing(*args, **kw):
        if broken == "append_events":
            real(*args, **kw)  # stored, then the batch dies
        raise OSError("killed")

    monkeypatch.setattr(ingest, broken, failing)
    with pytest.raises(OSError):
        ingest.ingest_batch(raw(spark, *batch(2)), paths, "s-2", stamp=NOW)
    monkeypatch.undo()
    for _ in range(2):
        ingest.ingest_batch(raw(spark, *batch(2)), paths, "s-2", stamp=NOW)
    assert partials.read_activity(spark, paths.partials).agg(F.sum("event_count")).first()[0] == 80
    same(spark, paths, 60 * 40)


def test_refresh_after_a_roll_up_equals_the_one_before(spark, paths):
    for seed in range(3):
        ingest.ingest_batch(raw(spark, *batch(seed)), paths, f"s-{seed}", stamp=ago(minutes=30 * (2 - seed)))
    assert ingest.roll_up_batches(spark, paths, unchanged_hours=0)["partials"] == 3
    for minutes in (75, 60 * 40):
        same(spark, paths, minutes)
    ingest.ingest_batch(raw(spark, *batch(3)), paths, "s-3", stamp=NOW)
    same(spark, paths, 60 * 40)


def test_lags_may_add_up_to_more_than_a_long_holds(spark, paths):
    old = datetime(1700, 1, 1, tzinfo=timezone.utc)
    for name, n in (("s-0", 1100), ("s-1", 600)):
        rows = [event(f"{name}-{i}", created=old) for i in range(n)] + batch(n)
        ingest.ingest_batch(raw(spark, *rows), paths, name, stamp=NOW)
    assert partials.read_lag(spark, paths.partials).agg(F.sum("lag_sum")).first()[0] > 1 << 63
    got = same(spark, paths, 60)["lag"].first()
    assert got.sample_size > 1700
    assert ingest.roll_up_batches(spark, paths, unchanged_hours=0)["partials"] == 2
    assert same(spark, paths, 60)["lag"].first() == got


def test_lag_sums_stored_as_longs_are_read(spark, paths):
    for name in ("s-0", "s-1"):
        ingest.ingest_batch(raw(spark, *batch(name)), paths, name, stamp=NOW)
    first = partials.read_lag(spark, paths.partials).where("ingest_batch = 's-0'").drop("ingest_batch").collect()
    longs = spark.createDataFrame(
        [r.asDict() | {"lag_sum": int(r.lag_sum)} for r in first],
        "ingested_at timestamp, n bigint, lag_sum bigint, lag_min bigint, lag_max bigint, day string",
    )
    replace_batch(longs, f"{paths.partials}/lag", "s-0", ["day"])
    same(spark, paths, 60)
    ingest.roll_up_batches(spark, paths, unchanged_hours=0)
    same(spark, paths, 60)


def test_partials_need_counters(tmp_path):
    with pytest.raises(ValueError):
        ingest.IngestPaths("a", "b", partials="c")


def test_refresh_of_nothing(spark, paths, tmp_path):
    found = refresh.metric_tables(spark, paths.events, to_micros(NOW), 60, partials_path=paths.partials)
    assert all(rows.count() == 0 for rows in found.values())


def test_merged_sketches_stay_within_their_error(spark):
    events = spark.range(120_000).select(
        F.lit("PushEvent").alias("event_type"),
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("r"), F.col("id") % 7)).alias("repo_name"),
        F.concat(F.lit("actor"), F.col("id") % 50_000).alias("actor_login"),
        (F.lit(NOW).cast("timestamp") - F.make_dt_interval(mins=F.col("id") % 3000)).alias("created_at"),
        F.lit("2026-03-10").alias("date"),
    )
    parts = hourly.hourly_counts(events)
    got = {r.repo_name: r for r in hourly.top_entities(parts, 10).collect()}
    want = {r.repo_name: r for r in activity.top_entities(events, 60 * 100, 10, to_micros(NOW)).collect()}
    assert set(got) == set(want)
    bound = 4 * 1.04 / math.sqrt(1 << hourly.SKETCH_LG_K)
    for repo, row in want.items():
        assert got[repo].event_count == row.event_count and got[repo].last_seen_at == row.last_seen_at
        assert abs(got[repo].unique_actors / row.unique_actors - 1) <= bound
    assert tables.read_events(spark, "/nowhere").count() == 0
