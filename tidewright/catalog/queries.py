"""One registered query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.catalog import roles
from tidewright.functions.bands import evidence_strength
from tidewright.functions.time_bounds import MICROS_PER_HOUR, date_key, hour_bucket, latest_micros, to_micros
from tidewright.operators import (
    activity,
    cases as C,
    detection,
    evaluation,
    flatten,
    hourly,
    neighbor_index,
    neighbors,
    outcomes,
    ranking,
    rules,
    snapshot,
    windowed,
)
from tidewright.operators.dedupe import first_per_key, not_stored
from tidewright.operators.order_stats import median_and_tail
from tidewright.plans import feed, formats, knowledge, maintenance
from tidewright.schemas import DLQ_SCHEMA, EVENT_COLUMNS, EVENT_TABLE_SCHEMA
from tidewright.session import pin_utc, work_dir, written
from tidewright.sources import anomaly_store, landing, sinks, streams, tables
from tidewright.streaming import ingest, refresh

Query = Callable[[SparkSession, str], DataFrame]

WEEK_MINUTES = 7 * 24 * 60
# One ingest stamp for all rehearsals: after every event of the log.
STAMP = datetime(2024, 2, 1, tzinfo=timezone.utc)
# Late threshold that splits the log into dated and late rows.
THRESHOLD_HOURS = 15 * 24
EMBED_DIM = 512

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _ntz(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _round(rows: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return rows.withColumns({n: F.round(F.col(n), places) for n in names})


def _as_of(spark: SparkSession, sf_dir: str, shift_hours: float = 0) -> int:
    latest = latest_micros(roles.table(spark, sf_dir, "events"), "ts")
    return (latest or 0) + int(shift_hours * MICROS_PER_HOUR)


# ---- activity ------------------------------------------------------------


@query
def event_counts(spark, sf):
    return activity.event_counts(roles.events(spark, sf), WEEK_MINUTES)


@query
def top_entities(spark, sf):
    return activity.top_entities(roles.events(spark, sf), WEEK_MINUTES, 10)


@query
def total_events(spark, sf):
    return activity.total_events(roles.events(spark, sf))


@query
def latest_event(spark, sf):
    return activity.latest_event(roles.events(spark, sf))


@query
def lag_stats(spark, sf):
    return activity.lag_stats(roles.events(spark, sf), WEEK_MINUTES)


@query
def lag_band(spark, sf):
    return activity.lag_report(roles.events(spark, sf), WEEK_MINUTES).select(
        "sample_size", "status"
    )


@query
def recent_events(spark, sf):
    return activity.recent_events(roles.events(spark, sf), 20)


@query
def recent_by_type(spark, sf):
    return activity.recent_events(roles.events(spark, sf), 20, "PushEvent")


@query
def type_share(spark, sf):
    counts = activity.event_counts(roles.events(spark, sf), WEEK_MINUTES)
    return _round(ranking.share_of_total(counts, "event_count"), "pct")


@query
def type_bar(spark, sf):
    counts = activity.event_counts(roles.events(spark, sf), WEEK_MINUTES)
    return ranking.share_of_max(counts, "event_count")


@query
def entity_rank(spark, sf):
    top = activity.top_entities(roles.events(spark, sf), WEEK_MINUTES, 10, entity="actor_login")
    return ranking.ranked(
        top.select("actor_login", "event_count"), F.desc("event_count"), "actor_login"
    )


@query
def bench_q1_top_repos(spark, sf):
    return activity.top_counts(roles.events(spark, sf))


@query
def bench_q2_type_distribution(spark, sf):
    return activity.type_distribution(roles.events(spark, sf))


@query
def bench_q3_recent_count(spark, sf):
    return activity.recent_count(roles.events(spark, sf), 1)


@query
def bench_q4_actor_activity(spark, sf):
    return activity.actor_activity(roles.events(spark, sf))


@query
def bench_q5_push_stats(spark, sf):
    return activity.payload_sum(roles.payload_events(spark, sf))


@query
def latency_percentiles(spark, sf):
    rows = roles.events(spark, sf).select("event_type", "value")
    return _round(median_and_tail(rows, ["event_type"], "value"), "p50", "p99")


@query
def event_date_keys(spark, sf):
    rows = roles.events(spark, sf)
    return (
        rows.select(
            date_key(F.col("created_at")).alias("day"),
            hour_bucket(F.col("created_at")).alias("hour"),
        )
        .groupBy("day", "hour")
        .agg(F.count("*").alias("n"))
    )


# ---- windows, rules, snapshot --------------------------------------------


@query
def failure_rate_windows(spark, sf):
    rows = windowed.failure_rates(roles.ci_runs(spark, sf), _as_of(spark, sf))
    return _round(rows, "recent_failure_rate", "baseline_failure_rate")


@query
def failing_workflows(spark, sf):
    rows = windowed.failing_workflows(roles.ci_runs(spark, sf), _as_of(spark, sf), 168, 5)
    return _round(rows, "failure_rate")


@query
def failing_workflows_by_repo(spark, sf):
    rows = windowed.failing_workflows(
        roles.ci_runs(spark, sf), _as_of(spark, sf), 720, 3, per_repo=True
    )
    return _round(rows, "failure_rate")


@query
def merge_hours_windows(spark, sf):
    rows = windowed.merge_times(roles.payload_events(spark, sf), _as_of(spark, sf))
    return _round(rows, "recent_avg_merge_hours", "baseline_avg_merge_hours")


@query
def event_rate_windows(spark, sf):
    rows = windowed.push_rates(roles.events(spark, sf), _as_of(spark, sf))
    return _round(rows, "recent_pushes_per_hour", "baseline_pushes_per_hour")


@query
def merged_recent(spark, sf):
    return windowed.merged_recent(roles.payload_events(spark, sf), _as_of(spark, sf), 24, 10)


@query
def merged_recent_by_repo(spark, sf):
    return windowed.merged_recent(
        roles.payload_events(spark, sf), _as_of(spark, sf), 168, 3, per_repo=True
    )


def _anomaly_columns(found: DataFrame) -> DataFrame:
    metric = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("metric")),
            lambda e: F.concat_ws(
                "=",
                e.getField("key"),
                F.format_string("%.3f", F.bround(e.getField("value"), 3)),
            ),
        ),
        ";",
    )
    return _ntz(
        found.withColumn("metric", metric), "detected_at"
    )


@query
def rule_failure_spike(spark, sf):
    at = _as_of(spark, sf)
    rates = windowed.failure_rates(roles.ci_runs(spark, sf), at, 6)
    return _anomaly_columns(detection.failure_spike(rates, at, 6)).select(
        "anomaly_id", "type", "title", "severity", "description", "repo", "metric"
    )


@query
def rule_merge_stretch(spark, sf):
    at = _as_of(spark, sf)
    times = windowed.merge_times(roles.payload_events(spark, sf), at, 48, 336)
    return _anomaly_columns(detection.merge_stretch(times, at, 48)).select(
        "anomaly_id", "type", "title", "severity", "description", "repo", "metric"
    )


@query
def rule_drought(spark, sf):
    at = _as_of(spark, sf, 22)
    rates = windowed.push_rates(roles.events(spark, sf), at)
    return _anomaly_columns(detection.activity_drought(rates, at)).select(
        "anomaly_id", "type", "title", "severity", "description", "repo", "metric"
    )


# Window hours, baseline hours and hours after the newest event, chosen so that rules speak up.
RULE_TIMES = ((24, 168, 20), (6, 168, 0), (2, 48, 1), (12, 336, -100), (48, 336, 0))


def _anomalies_at_times(spark, sf, repo=None) -> DataFrame:
    events, runs, found = roles.payload_events(spark, sf), roles.ci_runs(spark, sf), None
    for window, baseline, shift in RULE_TIMES:
        rows = detection.detect_all(events, runs, _as_of(spark, sf, shift), repo, window, baseline)
        found = rows if found is None else found.unionByName(rows)
    return _anomaly_columns(found).select("anomaly_id", "type", "severity", "repo", "metric", "detected_at")


@query
def all_anomalies(spark, sf):
    """All rules over the stream and every repository, at several times and windows."""
    return _anomalies_at_times(spark, sf)


@query
def repo_anomalies(spark, sf):
    """The scalar form: one repository for the event rules."""
    return _anomalies_at_times(spark, sf, "org/repo-3")


@query
def health_signal(spark, sf):
    at = _as_of(spark, sf)
    rows = detection.health_signal(roles.payload_events(spark, sf), roles.ci_runs(spark, sf), at)
    return rows.select(
        "scope",
        "repo_name",
        F.col("ci_stability.status").alias("ci_status"),
        F.col("pr_velocity.status").alias("pr_status"),
        F.col("commit_cadence.status").alias("cadence_status"),
        F.col("ci_stability.runs").alias("ci_runs"),
        F.round("ci_stability.failure_rate", 6).alias("ci_rate"),
        F.round("ci_stability.baseline_failure_rate", 6).alias("ci_baseline"),
        F.round("pr_velocity.avg_merge_hours", 6).alias("merge_hours"),
        F.round("pr_velocity.baseline_avg_merge_hours", 6).alias("merge_baseline"),
        F.round("commit_cadence.pushes_per_hour", 6).alias("pushes_per_hour"),
        F.round("commit_cadence.baseline_pushes_per_hour", 6).alias("pushes_baseline"),
        "caption",
    )


def _snapshots(spark, sf, hours=24):
    at = _as_of(spark, sf)
    return at, snapshot.evidence_snapshot(
        roles.payload_events(spark, sf), roles.ci_runs(spark, sf), at, window_hours=hours
    )


@query
def snapshot_text(spark, sf):
    _, rows = _snapshots(spark, sf)
    return rows.select("scope", "repo", snapshot.snapshot_text().alias("text"))


@query
def snapshot_anomaly(spark, sf):
    at, rows = _snapshots(spark, sf)
    found = snapshot.snapshot_anomaly(rows, at)
    metric = {
        name: F.round(F.col("metric")[name], 6).alias(name)
        for name in ("recent_failure_rate", "baseline_failure_rate", "recent_runs")
    }
    return found.select("anomaly_id", "type", "title", "severity", "description", "repo", "is_demo", *metric.values())


@query
def freshness(spark, sf):
    return snapshot.freshness(
        roles.events(spark, sf), roles.ci_runs(spark, sf), roles.cases(spark, sf)
    )


def _anomaly_rows(spark, sf, hours: int) -> DataFrame:
    """One anomaly row per repository and day of the log."""
    day = F.date_trunc("DAY", F.col("created_at").cast("timestamp"))
    return (
        roles.events(spark, sf)
        .groupBy("repo_name", day.alias("day"))
        .agg(F.count("*").alias("n"))
        .withColumn("detected_at", F.timestamp_add("HOUR", F.lit(hours), F.col("day")))
        .select(
            detection.anomaly_id(F.lit("commit_drought"), F.col("day"), F.col("repo_name")).alias(
                "anomaly_id"
            ),
            F.lit("commit_drought").alias("type"),
            F.concat(F.lit("seen "), F.col("n")).alias("title"),
            F.lit("low").alias("severity"),
            F.lit(None).cast("string").alias("description"),
            F.create_map(F.lit("n"), F.col("n").cast("double")).alias("metric"),
            F.col("repo_name").alias("repo"),
            "detected_at",
            F.lit(False).alias("is_demo"),
        )
    )


@query
def anomaly_merge(spark, sf):
    """Stored rows win; rows of a later sweep are added only when new."""
    path = work_dir(spark, "anomalies")
    first = _anomaly_rows(spark, sf, 1)
    anomaly_store.save(spark, first.where(F.col("repo") < "org/repo-5"), path)
    anomaly_store.save(spark, _anomaly_rows(spark, sf, 2), path)
    stored = anomaly_store.load(spark, path)
    return _ntz(
        stored.select(
            "anomaly_id", "title", "repo", "detected_at", F.col("metric")["n"].alias("n")
        ),
        "detected_at",
    )


@query
def anomaly_lookup(spark, sf):
    """Point look-up of every stored id by join."""
    rows = anomaly_store.to_rows(_anomaly_rows(spark, sf, 1))
    ids = roles.events(spark, sf).select(
        detection.anomaly_id(
            F.lit("commit_drought"),
            F.date_trunc("DAY", F.col("created_at").cast("timestamp")),
            F.col("repo_name"),
        ).alias("anomaly_id")
    )
    return (
        ids.join(rows, "anomaly_id")
        .groupBy("repo")
        .agg(F.count("*").alias("n"), F.countDistinct("anomaly_id").alias("anomalies"))
    )


# ---- ingest --------------------------------------------------------------


def _validated(spark, sf) -> DataFrame:
    return rules.validate(flatten.parse_raw(roles.raw_events(spark, sf)))


def _stamp():
    return F.lit(STAMP.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def _routed(spark, sf) -> DataFrame:
    flat = flatten.flatten(rules.accepted(_validated(spark, sf)), _stamp())
    return flatten.with_partition(flat, THRESHOLD_HOURS)


@query
def flatten_events(spark, sf):
    rows = flatten.flatten(flatten.parse_raw(roles.raw_events(spark, sf)), _stamp())
    return _ntz(
        rows.select(
            "event_id",
            "event_type",
            "actor_id",
            "actor_login",
            "repo_id",
            "repo_name",
            "public",
            "created_at",
            "ingested_at",
            F.col("payload_json").isNotNull().alias("has_payload"),
        ),
        "created_at",
        "ingested_at",
    )


def _metric_query(event_type: str, names: list[str]) -> Query:
    def run(spark, sf):
        rows = rules.emitted_metrics(_validated(spark, sf))
        return rows.where(F.col("event_type") == event_type).select(
            "event_id", *[F.col("metrics")[n].alias(n) for n in names]
        )

    return run


_METRICS = {
    "validate_push": ("PushEvent", ["commit_count", "branch", "is_default_branch", "distinct_size"]),
    "validate_pull_request": (
        "PullRequestEvent",
        ["action", "pr_number", "is_merged", "is_draft", "target_branch", "additions", "deletions", "changed_files"],
    ),
    "validate_issues": (
        "IssuesEvent",
        ["action", "issue_number", "is_closed", "label_count", "comment_count"],
    ),
    "validate_fork": ("ForkEvent", ["fork_full_name", "fork_owner", "is_private"]),
    "validate_create": ("CreateEvent", ["ref_type", "ref_name", "is_tag", "is_semver_tag"]),
    "validate_watch": ("WatchEvent", ["action"]),
}
for _name, (_type, _fields) in _METRICS.items():
    _fn = _metric_query(_type, _fields)
    _fn.__name__ = _name
    query(_fn)


@query
def validate_default(spark, sf):
    """The log's own type names have no rules, so the default ones apply."""
    raw = roles.table(spark, sf, "events").select(
        F.to_json(
            F.struct(
                F.when(F.col("user_id") % 50 != 49, F.col("event_id")).alias("id"),
                F.col("event_type").alias("type"),
            )
        ).alias("value")
    )
    rows = rules.validate(flatten.parse_raw(raw))
    return (
        rows.groupBy(F.col("ev")["type"].alias("event_type"), "error_reason")
        .agg(F.count("*").alias("n"))
    )


@query
def dead_letter(spark, sf):
    rows = rules.dead_letters(_validated(spark, sf), _stamp())
    return rows.select("event_id", "event_type", "error_reason")


@query
def dead_letter_latest(spark, sf):
    """Dead letters written and read back, newest first."""
    path = work_dir(spark, "dead-letters")
    valid = _validated(spark, sf)
    failed_at = F.timestamp_add("SECOND", F.col("position"), _stamp())
    sinks.write_dead_letters(rules.dead_letters(valid, failed_at), path, "rehearsal-0")
    sinks.write_dead_letters(rules.dead_letters(valid, failed_at), path, "rehearsal-0")
    latest = tables.latest_dead_letters(tables.read_dead_letters(spark, path), 20)
    return _ntz(latest.select("event_id", "event_type", "error_reason", "failed_at"), "failed_at")


@query
def partition_route(spark, sf):
    return _routed(spark, sf).select("event_id", "date")


def _redelivered(spark, sf) -> DataFrame:
    """Every raw event twice, the second time later and with another payload."""
    raw = roles.raw_events(spark, sf)
    again = raw.select(
        F.replace("value", F.lit('"public":true'), F.lit('"public":false')).alias("value"),
        (F.col("position") + F.lit(10_000_000_000)).alias("position"),
    )
    return again.unionByName(raw)


@query
def dedupe_first(spark, sf):
    rows = rules.validate(flatten.parse_raw(_redelivered(spark, sf)))
    flat = flatten.flatten(rules.accepted(rows), _stamp())
    return first_per_key(flat, "event_id", "position").select("event_id", "public", "position")


@query
def dedupe_stored(spark, sf):
    """Everything arrives again while the push events are stored."""
    routed = _routed(spark, sf)
    stored = routed.where(F.col("event_type") == "PushEvent")
    return not_stored(routed, stored).select("event_id", "event_type")


def _ingested(spark, sf, max_files: int | None = 2, partials: bool = False):
    """Run the stream over landed text files until they are drained."""
    root = work_dir(spark, "ingest")
    _redelivered(spark, sf).select("value").write.text(f"{root}/landing")
    paths = ingest.IngestPaths(
        f"{root}/events",
        f"{root}/dead",
        f"{root}/metrics",
        f"{root}/counters",
        f"{root}/partials" if partials else None,
    )
    ingest.start_ingest(
        streams.file_events(spark, f"{root}/landing", max_files),
        paths,
        f"{root}/checkpoint",
        "rehearsal",
        THRESHOLD_HOURS,
        flush_seconds=None,
        clock=lambda: STAMP,
    ).awaitTermination()
    # A dead letter that could not be stored fails the query.
    ingest.deliver_dead_letters(spark, paths)
    return paths


@query
def stream_ingest(spark, sf):
    paths = _ingested(spark, sf)
    rows = tables.read_events(spark, paths.events)
    return _ntz(
        rows.select(
            "event_id", "event_type", "actor_id", "actor_login", "repo_name", "created_at", "date"
        ),
        "created_at",
    )


@query
def stream_dead_letters(spark, sf):
    paths = _ingested(spark, sf)
    rows = tables.read_dead_letters(spark, paths.dead_letters)
    return rows.groupBy("event_type", "error_reason").agg(F.count("*").alias("n"))


@query
def ingest_counters(spark, sf):
    """One batch as it came and one in which everything comes twice again."""
    root = work_dir(spark, "counters")
    paths = ingest.IngestPaths(f"{root}/events", f"{root}/dead", counters=f"{root}/counters")
    for batch, rows in (("c-0", roles.raw_events(spark, sf)), ("c-1", _redelivered(spark, sf))):
        ingest.ingest_batch(rows, paths, batch, THRESHOLD_HOURS, STAMP)
    return ingest.ingest_counters(spark, paths.counters)


@query
def stream_metrics(spark, sf):
    paths = _ingested(spark, sf)
    rows = tables.read_batches(spark, paths.metrics, ingest.METRICS_SCHEMA)
    return rows.groupBy("event_type").agg(
        F.countDistinct("event_id").alias("events"),
        F.count_if(F.map_contains_key("metrics", "event_type")).alias("with_type_key"),
    )


@query
def metric_refresh(spark, sf):
    """Refresh driven by the event table as a stream."""
    paths = _ingested(spark, sf, None)
    root = work_dir(spark, "refresh")
    refresh.start_refresh(
        spark,
        paths.events,
        f"{root}/out",
        f"{root}/checkpoint",
        as_of=STAMP,
        since_minutes=WEEK_MINUTES,
        seconds=None,
    ).awaitTermination()
    return _round(spark.read.parquet(f"{root}/out/event_counts"), "pct")


# A look-back that begins inside an hour.
BROKEN_WEEK_MINUTES = WEEK_MINUTES + 25


@query
def metric_refresh_hourly(spark, sf):
    """The refresh from hourly partials of the ingest, before and after their roll-up."""
    paths = _ingested(spark, sf, partials=True)
    counts = []
    for _ in range(2):
        found = refresh.metric_tables(
            spark, paths.events, to_micros(STAMP), BROKEN_WEEK_MINUTES, partials_path=paths.partials
        )
        counts.append(_round(written(found["event_counts"], "counts"), "pct"))
        ingest.roll_up_batches(spark, paths, unchanged_hours=0)
    return counts[0].intersect(counts[1])


@query
def top_entities_sketch(spark, sf):
    """Top entities from hourly partials; distinct actors estimated within 5 % of the exact count."""
    events = _as_table(
        roles.payload_events(spark, sf).withColumn("public", F.lit(True)).withColumn("actor_id", F.col("user_id"))
    )
    at = to_micros(STAMP)
    parts = hourly.counts_since(hourly.hourly_counts(events), events, at, 40 * 24 * 60 + 25)
    exact = activity.top_entities(events, 40 * 24 * 60 + 25, 10, at).select(
        "repo_name", F.col("unique_actors").alias("exact")
    )
    rows = hourly.top_entities(parts, 10).join(exact, "repo_name")
    close = F.abs(F.col("unique_actors") - F.col("exact")) <= F.col("exact") * 0.05
    return _ntz(rows.select("repo_name", "event_count", "last_seen_at", close.alias("actors_close")), "last_seen_at")


@query
def rolled_dead_letters(spark, sf):
    """Dead letters after their batches were merged, with the batches sent once more."""
    paths = _ingested(spark, sf)
    rejected = tables.read_dead_letters(spark, paths.dead_letters)
    again = written(rejected.drop("ingest_batch"), "again")
    ingest.roll_up_batches(spark, paths, unchanged_hours=0)
    sinks.write_dead_letters(again, paths.dead_letters, "rehearsal-0")
    rows = tables.read_dead_letters(spark, paths.dead_letters)
    return rows.groupBy("event_type", "error_reason").agg(F.count("*").alias("n"))


@query
def anomaly_sweep(spark, sf):
    """Two sweeps in the same hour store every anomaly once."""
    root = work_dir(spark, "sweep")
    events = roles.payload_events(spark, sf).withColumn("public", F.lit(True)).withColumn(
        "actor_id", F.col("user_id")
    )
    dated = _as_table(events)
    sinks.append_events(dated, f"{root}/events")
    sinks.overwrite(
        roles.ci_runs(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp")),
        f"{root}/runs",
    )
    at = _as_of(spark, sf, 20)
    for attempt in range(2):
        refresh.start_sweeps(
            spark,
            f"{root}/events",
            f"{root}/runs",
            f"{root}/anomalies",
            f"{root}/checkpoint-{attempt}",
            as_of=at,
            seconds=None,
        ).awaitTermination()
    rows = anomaly_store.load(spark, f"{root}/anomalies")
    return _ntz(rows.select("anomaly_id", "type", "severity", "repo", "detected_at"), "detected_at")


@query
def jsonl_roundtrip(spark, sf):
    path = work_dir(spark, "jsonl")
    ingest.ingest_jsonl(roles.raw_events(spark, sf), path, THRESHOLD_HOURS, STAMP)
    rows = tables.read_events_jsonl(spark, path)
    return _ntz(
        rows.select("event_id", "event_type", "actor_id", "repo_name", "created_at", "date"),
        "created_at",
    )


@query
def json_lines_text(spark, sf):
    """Rows as JSON text with ISO timestamps, read back by path."""
    rows = roles.events(spark, sf).select("event_id", "actor_login", "created_at")
    line = flatten.as_json_line(_tz(rows, "created_at"))
    return line.select(
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.created_at").alias("created_at"),
        F.get_json_object("value", "$.actor_login").alias("actor_login"),
    )


def _tz(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("timestamp") for n in names})


# ---- table maintenance ---------------------------------------------------


@query
def recent_feed(spark, sf):
    """The feed of a stored table, pruned to its newest partitions."""
    return _ntz(feed.recent_feed(spark, _loaded(spark, sf), 20, "WatchEvent"), "created_at")


@query
def newest_partition_event(spark, sf):
    """Freshness of a stored table from its newest partition."""
    return _ntz(
        activity.latest_event(tables.read_newest_events(spark, _loaded(spark, sf))), "latest"
    )


def _as_table(events: DataFrame) -> DataFrame:
    """Role rows in the stored layout under their event date."""
    return _tz(events, "created_at", "ingested_at").withColumn(
        "date", date_key(F.col("created_at"))
    )


def _loaded(spark, sf) -> str:
    """The event table written in one load per event type."""
    path = work_dir(spark, "events")
    rows = _as_table(
        roles.payload_events(spark, sf)
        .withColumn("public", F.lit(True))
        .withColumn("actor_id", F.col("user_id"))
    )
    for event_type in [*roles.TYPE_OF.values(), "CreateEvent", "ForkEvent"]:
        sinks.append_events(rows.where(F.col("event_type") == event_type), path)
    return path


@query
def compact_partitions(spark, sf):
    """Summary of a compaction after one load per event type."""
    summary = maintenance.compact(spark, _loaded(spark, sf))
    return summary.select("partition", "skipped", "files_before", "files_after", "rows")


@query
def compacted_table(spark, sf):
    """The table after compaction holds the same rows."""
    path = _loaded(spark, sf)
    maintenance.compact(spark, path)
    rows = tables.read_events(spark, path)
    return rows.groupBy("date", "event_type").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("ids")
    )


@query
def compaction_totals(spark, sf):
    path = _loaded(spark, sf)
    return maintenance.compaction_totals(maintenance.compact(spark, path, min_files=2))


@query
def list_partitions(spark, sf):
    return maintenance.partition_files(spark, _loaded(spark, sf)).select("partition")


@query
def partition_files(spark, sf):
    """Files and rows of every date, half of the dates compacted."""
    path = _loaded(spark, sf)
    names = maintenance.partitions(spark, path)
    maintenance.compact(spark, path, only=names[: len(names) // 2])
    return maintenance.partition_files(spark, path)


@query
def dlq_replay(spark, sf):
    """Everything was rejected once; the replay stores what passes now."""
    root = work_dir(spark, "replay")
    raw = roles.raw_events(spark, sf)
    old = raw.select(
        F.lit("").alias("event_id"),
        F.lit("unknown").alias("event_type"),
        F.lit("rejected by an older rule").alias("error_reason"),
        F.col("value").alias("raw_json"),
        _stamp().alias("failed_at"),
    )
    sinks.write_dead_letters(old.select(*DLQ_SCHEMA.names), f"{root}/old", "rehearsal-0")
    paths = ingest.IngestPaths(f"{root}/events", f"{root}/dead")
    maintenance.replay_dead_letters(
        spark, f"{root}/old", paths, "replay-0", threshold_hours=THRESHOLD_HOURS, stamp=STAMP
    )
    stored = tables.read_events(spark, paths.events).select("event_type", F.lit(True).alias("ok"))
    dead = tables.read_dead_letters(spark, paths.dead_letters).select(
        "event_type", F.lit(False).alias("ok")
    )
    return stored.unionByName(dead).groupBy("event_type", "ok").agg(F.count("*").alias("n"))


@query
def backfill_partitions(spark, sf):
    """A table by ingest date moves to event date, with its missing columns."""
    root = work_dir(spark, "backfill")
    rows = _tz(roles.payload_events(spark, sf), "created_at", "ingested_at")
    old = rows.select(
        "event_id", "event_type", "actor_login", "repo_name", "created_at", "ingested_at",
        date_key(F.col("ingested_at")).alias("date"),
    )
    old.write.partitionBy("date").parquet(f"{root}/old")
    maintenance.backfill(
        spark,
        f"{root}/old",
        EVENT_TABLE_SCHEMA,
        f"{root}/new",
        {
            **{name: F.col(name) for name in EVENT_COLUMNS},
            "date": date_key(F.col("created_at")),
        },
    )
    new = tables.read_events(spark, f"{root}/new")
    return new.groupBy("date").agg(
        F.count("*").alias("n"), F.count_if(F.col("public").isNull()).alias("without_public")
    )


@query
def schema_evolution(spark, sf):
    """Old files lack columns that newer files have; both read as one table."""
    path = work_dir(spark, "evolution")
    rows = _as_table(
        roles.payload_events(spark, sf)
        .withColumn("public", F.lit(True))
        .withColumn("actor_id", F.col("user_id"))
    )
    old = rows.where(F.col("event_type") == "PushEvent").drop("public", "repo_id")
    old.select(
        *[c for c in EVENT_COLUMNS if c in old.columns], "date"
    ).write.partitionBy("date").parquet(path)
    sinks.append_events(rows.where(F.col("event_type") != "PushEvent"), path)
    table = tables.read_events(spark, path)
    return table.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("public").alias("with_public"),
        F.count("repo_id").alias("with_repo_id"),
    )


def _pages(spark, sf) -> DataFrame:
    """Landed run pages of at most 100 runs each, one repository per page."""
    runs = roles.ci_runs(spark, sf)
    run = F.struct(
        F.col("run_id").alias("id"),
        F.col("workflow_name").alias("name"),
        "status",
        "conclusion",
        F.date_format("created_at", roles.ISO).alias("created_at"),
    )
    pages = runs.groupBy("repo", F.floor(F.col("run_id") / 100).alias("page")).agg(
        F.collect_list(run).alias("workflow_runs")
    )
    return pages.select("repo", F.to_json(F.struct("workflow_runs")).alias("value"))


@query
def ci_runs_build(spark, sf):
    runs = landing.ci_runs(_pages(spark, sf), F.col("repo"), None)
    path = work_dir(spark, "ci-runs")
    landing.write_ci_runs(runs, path)
    return _ntz(tables.read_ci_runs(spark, path), "created_at")


@query
def ci_runs_newest(spark, sf):
    """The capped form: the newest 20 runs of each repository."""
    runs = landing.ci_runs(_pages(spark, sf), F.col("repo"), 20)
    return _ntz(runs.select("run_id", "repo", "created_at"), "created_at")


@query
def ci_latest_run(spark, sf):
    return activity.latest_event(roles.ci_runs(spark, sf))


# ---- knowledge base ------------------------------------------------------


@query
def kb_cases(spark, sf):
    rows = roles.cases(spark, sf)
    return _round(
        _ntz(
            rows.select(
                "case_id", "kind", "number", "title", "body_snippet", "url",
                F.array_join("labels", ",").alias("labels"),
                "created_at", "closed_at", "time_to_resolve_hours",
            ),
            "created_at",
            "closed_at",
        ),
        "time_to_resolve_hours",
    )


@query
def revert_linkage(spark, sf):
    return roles.cases(spark, sf).select(
        "case_id", "is_revert", "reverts_number", "was_reverted", "reverted_by"
    )


@query
def build_totals(spark, sf):
    return C.build_totals(roles.cases(spark, sf))


@query
def case_count(spark, sf):
    return C.case_count(roles.cases(spark, sf))


@query
def case_text(spark, sf):
    return roles.cases(spark, sf).select("case_id", C.case_text().alias("text"))


@query
def label_pluck(spark, sf):
    rows = roles.cases(spark, sf).select(F.explode("labels").alias("label"))
    return rows.groupBy("label").agg(F.count("*").alias("n"))


@query
def newest_items(spark, sf):
    """The capped form of the landed items: the 50 updated last of each of four unequal repositories."""
    rows = roles.items(spark, sf).withColumn(
        "value",
        F.concat(
            F.lit('{"updated_at":"'),
            F.get_json_object("value", "$.created_at"),
            F.lit('",'),
            F.substring("value", 2, 2_000_000_000),
        ),
    )
    busy = F.col("position") % 10 < 7
    repo = F.when(busy, F.lit("busy")).otherwise(F.concat(F.lit("quiet-"), (F.col("position") % 3).cast("string")))
    return landing.newest_items(rows, 50, repo).select("position")


@query
def hash_embed(spark, sf):
    """Vectors of the default size, as figures of each."""
    rows = C.embed_cases(roles.cases(spark, sf), C.hash_embedder(EMBED_DIM))
    values = rows.select("case_id", F.posexplode("embedding").alias("i", "v"))
    value = F.col("v").cast("double")
    return values.groupBy("case_id").agg(
        F.count("*").alias("dims"),
        F.round(F.sum(value * (F.col("i") % 7 + 1)), 3).alias("weighted"),
        F.round(F.min(value), 5).alias("least"),
        F.round(F.max(value), 5).alias("most"),
        F.round(F.max(F.when(F.col("i") == EMBED_DIM - 1, value)), 5).alias("last"),
    )


@query
def knowledge_build(spark, sf):
    """Cases and vectors written, then joined for search."""
    root = work_dir(spark, "knowledge")
    knowledge.build_knowledge_base(
        roles.items(spark, sf), "position", f"{root}/cases", f"{root}/embeddings",
        C.hash_embedder(EMBED_DIM),
    )
    rows = knowledge.load_corpus(spark, f"{root}/cases", f"{root}/embeddings")
    return rows.groupBy("kind").agg(
        F.count("*").alias("n"), F.sum(F.size("embedding")).alias("dims")
    )


def _matches(found: DataFrame) -> DataFrame:
    return _round(
        neighbors.with_band(found).select(
            "query_id", "case_id", "rank", "similarity", "similarity_band"
        ),
        "similarity",
    )


@query
def cosine_topk(spark, sf):
    """Every vector as a query against every vector."""
    return _matches(
        neighbors.nearest(
            roles.vectors(spark, sf, "query_id"), roles.vectors(spark, sf), 5
        )
    )


@query
def index_neighbors(spark, sf):
    """The same with many blocks on both sides."""
    asked, corpus = roles.vectors(spark, sf, "query_id"), roles.vectors(spark, sf)
    return _matches(neighbors.nearest(asked, corpus, 5, block_queries=200, block_rows=300))


def _hundredths(spark, sf) -> DataFrame:
    return roles.vectors(spark, sf, "query_id").where(F.col("query_id") % 100 == 0)


@query
def approx_neighbors(spark, sf):
    """Every hundredth vector as a query against every vector in its buckets."""
    corpus = roles.vectors(spark, sf)
    return _matches(neighbor_index.fit(corpus, 5).nearest(_hundredths(spark, sf), corpus, 5))


@query
def approx_recall(spark, sf):
    """The same compared with the exact search."""
    corpus = roles.vectors(spark, sf)
    found = neighbor_index.fit(corpus, 5).nearest(_hundredths(spark, sf), corpus, 5)
    true = neighbors.nearest(_hundredths(spark, sf), corpus, 5)
    hit = found.select("query_id", "case_id", F.lit(1.0).alias("hit"))
    return (
        true.join(hit, ["query_id", "case_id"], "left")
        .agg(
            F.countDistinct("query_id").alias("n_queries"),
            F.count("*").alias("n_pairs"),
            (F.avg(F.coalesce("hit", F.lit(0.0))) >= 0.9).alias("recall_reached"),
        )
    )


def _corpus(spark, sf) -> DataFrame:
    """The searchable corpus as a stored table, as a job would find it."""
    return written(roles.corpus(spark, sf), "corpus")


def _searched(spark, sf, k=5):
    corpus = _corpus(spark, sf)
    return corpus, neighbors.search(roles.subjects(spark, sf), corpus, k)


@query
def corpus_join(spark, sf):
    rows = roles.corpus(spark, sf)
    return rows.select("case_id", "kind", F.size("embedding").alias("dim"))


@query
def outcome_estimate(spark, sf):
    corpus, found = _searched(spark, sf)
    estimate = outcomes.estimate_outcomes(roles.subjects(spark, sf), found, corpus)
    return _round(
        estimate.withColumn("severity_labels", F.array_join("severity_labels", ",")).withColumn(
            "evidence", evidence_strength(F.col("sample_size"))
        ),
        "revert_rate",
        "avg_time_to_resolve_hours",
    )


@query
def severity_labels(spark, sf):
    rows = outcomes.severity_labels(roles.cases(spark, sf), "kind")
    return rows.withColumn("severity_labels", F.array_join("severity_labels", ","))


@query
def outcomes_for_ids(spark, sf):
    """Outcome estimate of one set of ids: all pull requests, plus unknown ids."""
    known = written(roles.cases(spark, sf), "cases")
    ids = (
        known.where(F.col("kind") == "pr")
        .select("case_id")
        .unionByName(known.select(F.concat(F.lit("x-"), "case_id").alias("case_id")))
    )
    estimate = outcomes.estimate_for_ids(known, ids)
    return _round(
        estimate.withColumn("severity_labels", F.array_join("severity_labels", ",")),
        "revert_rate",
        "avg_time_to_resolve_hours",
    )


@query
def evidence_blocks(spark, sf):
    _, found = _searched(spark, sf, 3)
    rows = outcomes.evidence_blocks(found)
    return rows.select("query_id", F.posexplode("blocks").alias("i", "block"))


@query
def trimmed_cases(spark, sf):
    _, found = _searched(spark, sf, 3)
    rows = outcomes.trimmed_cases(found)
    return rows.select("query_id", F.explode("similar_cases").alias("c")).select(
        "query_id", "c.rank", "c.case_id", "c.similarity_band", "c.was_reverted", "c.snippet"
    )


@query
def context_text(spark, sf):
    _, found = _searched(spark, sf, 2)
    blocks = outcomes.evidence_blocks(found)
    rows = roles.subjects(spark, sf).join(blocks, "query_id", "left")
    live = F.when(F.col("query_id") % 2 == 0, F.concat(F.lit("live "), "query_id"))
    return rows.select(
        "query_id", outcomes.context_text(F.col("subject"), F.col("blocks"), live).alias("context")
    )


@query
def parse_output(spark, sf):
    rows = roles.generated_texts(spark, sf).withColumn(
        "g", outcomes.parse_generated(F.col("raw"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.col("g.summary").alias("summary"),
        F.array_join("g.suggested_actions", ",").alias("actions"),
        F.col("g.confidence").alias("confidence"),
    )


@query
def diagnosis(spark, sf):
    rows = knowledge.diagnose(
        roles.subjects(spark, sf), _corpus(spark, sf), 3, F.lit("all calm")
    )
    return _round(
        rows.select(
            "query_id",
            "subject",
            "sample_size",
            "evidence",
            "pr_count",
            "revert_rate",
            F.array_join("severity_labels", ",").alias("severity_labels"),
            F.array_join(
                F.transform("similar_cases", lambda c: c.getField("case_id")), ","
            ).alias("similar_cases"),
            F.size("raw_evidence").alias("n_evidence"),
            F.get("raw_evidence", F.lit(0)).alias("first_evidence"),
        ),
        "revert_rate",
    )


@query
def anomaly_diagnosis(spark, sf):
    """Stored anomalies as subjects against hash vectors of the cases."""
    embed = C.hash_embedder(EMBED_DIM)
    known = written(roles.cases(spark, sf), "cases")
    corpus = written(C.searchable(known, C.embed_cases(known, embed)), "corpus")
    anomalies = _anomaly_rows(spark, sf, 1)
    subjects = knowledge.anomaly_subjects(anomalies, embed)
    rows = knowledge.diagnose(subjects, corpus, 3)
    return rows.select(
        F.col("query_id").alias("anomaly_id"), "subject", "sample_size", "evidence"
    )


@query
def eval_set(spark, sf):
    """The unsampled form: every usable title."""
    return evaluation.eval_set(roles.cases(spark, sf), None)


@query
def eval_sample(spark, sf):
    """The sampling form: 50 titles by a seeded digest."""
    return evaluation.eval_set(roles.cases(spark, sf), 50, 42)


def _eval_pairs(spark, sf) -> DataFrame:
    """Half of the labels expect the vector's own case, the others the next one."""
    rows = roles.table(spark, sf, "embeddings")
    own = F.col("label") < 5
    expected = F.when(own, F.col("vec_id")).otherwise(F.col("vec_id") + 1)
    return rows.select(
        F.col("vec_id").alias("query_id"), "embedding", expected.alias("expected_case_id")
    )


@query
def recall_mrr(spark, sf):
    total, _ = evaluation.evaluate(_eval_pairs(spark, sf), roles.vectors(spark, sf))
    return total


@query
def eval_ranks(spark, sf):
    _, ranks = evaluation.evaluate(_eval_pairs(spark, sf), roles.vectors(spark, sf))
    return ranks


@query
def format_comparison(spark, sf):
    """The benchmark queries on both layouts: their number of rows and whether both agree."""
    path = _loaded(spark, sf)
    mirror = work_dir(spark, "mirror")
    sinks.append_events_jsonl(tables.read_events(spark, path), mirror)
    return formats.compare_formats(spark, path, mirror, _as_of(spark, sf))
