"""Anomaly rules and the three-part signal for every repository in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.bands import descending_band
from tidewright.functions.text import one_decimal, percent
from tidewright.functions.time_bounds import hour_bucket
from tidewright.operators import windowed

# Minimum samples below which a rule stays silent.
MIN_CI_RUNS = 5
MIN_MERGED = 3
MIN_BASELINE_RATE = 1.0

SIGNAL_CAPTION = "Based on CI/PR/commit signals — not a live production health check"


def at_time(as_of: int) -> Column:
    return F.timestamp_micros(F.lit(as_of))


def anomaly_id(anomaly_type: Column, detected_at: Column, repo: Column) -> Column:
    """Same type, hour and repository give the same id."""
    key = F.concat_ws(":", anomaly_type, hour_bucket(detected_at), repo)
    return F.substring(F.sha1(key), 1, 12)


def _record(
    as_of: int,
    anomaly_type: str,
    title: Column,
    severity: Column,
    description: Column,
    metric: dict[str, Column],
) -> Column:
    """An anomaly of the row's repository as one struct."""
    pairs = [c for k, v in metric.items() for c in (F.lit(k), v.cast("double"))]
    return F.struct(
        anomaly_id(F.lit(anomaly_type), at_time(as_of), F.col("repo_name")).alias("anomaly_id"),
        F.lit(anomaly_type).alias("type"),
        title.alias("title"),
        severity.alias("severity"),
        description.alias("description"),
        F.create_map(*pairs).alias("metric"),
        F.col("repo_name").alias("repo"),
        at_time(as_of).alias("detected_at"),
        F.lit(False).alias("is_demo"),
    )


def _records(rows: DataFrame, *rules: tuple[Column, Column]) -> DataFrame:
    """The records of all rules that hold, from one pass over the rows."""
    found = F.array_compact(F.array(*[F.when(test, record) for test, record in rules]))
    return rows.select(F.explode(found).alias("r")).select("r.*")


def failure_spike(rates: DataFrame, as_of: int, window_hours: float = 24) -> DataFrame:
    """Failure rate above max(1.5 x baseline, 0.2) with enough runs."""
    rate = F.col("recent_failure_rate")
    base = F.coalesce("baseline_failure_rate", F.lit(0.0))
    test = (
        rate.isNotNull()
        & (F.col("recent_runs") >= MIN_CI_RUNS)
        & (rate > F.greatest(base * 1.5, F.lit(0.2)))
    )
    ratio = F.coalesce(F.try_divide(rate, base), F.lit(float("inf")))
    severity = F.when((ratio >= 3) | (rate >= 0.5), "high").otherwise(
        descending_band(ratio, [(2, "medium")], "low")
    )
    record = _record(
        as_of,
        "ci_failure_spike",
        F.concat(F.lit("CI failure rate spiked to "), percent(rate)),
        severity,
        F.format_string(
            f"CI failure rate over the last {window_hours:g}h is %s (%d runs), vs a %s baseline.",
            percent(rate),
            F.col("recent_runs"),
            percent(base),
        ),
        {
            "recent_failure_rate": rate,
            "baseline_failure_rate": base,
            "recent_runs": F.col("recent_runs"),
            "baseline_runs": F.col("baseline_runs"),
        },
    )
    return _records(rates, (test, record))


def _merge_stretch(as_of: int, window_hours: float) -> tuple[Column, Column]:
    recent, base = F.col("recent_avg_merge_hours"), F.col("baseline_avg_merge_hours")
    ratio = F.try_divide(recent, base)
    test = (
        (base > 0)
        & (F.col("recent_merged") >= MIN_MERGED)
        & (F.col("baseline_merged") >= MIN_MERGED)
        & (ratio > 1.5)
    )
    return test, _record(
        as_of,
        "merge_time_anomaly",
        F.format_string("PR merge time %sx above baseline", one_decimal(ratio)),
        descending_band(ratio, [(3, "high"), (2, "medium")], "low"),
        F.format_string(
            f"PRs merged in the last {window_hours:g}h averaged %sh open-to-merge, "
            "vs a %sh baseline.",
            one_decimal(recent),
            one_decimal(base),
        ),
        {
            "recent_avg_merge_hours": recent,
            "baseline_avg_merge_hours": base,
            "recent_merged": F.col("recent_merged"),
            "ratio": ratio,
        },
    )


def merge_stretch(times: DataFrame, as_of: int, window_hours: float = 24) -> DataFrame:
    """Mean merge time above 1.5 x baseline with enough merges on both sides."""
    return _records(times, _merge_stretch(as_of, window_hours))


def _activity_drought(as_of: int, window_hours: float) -> tuple[Column, Column]:
    recent, base = F.col("recent_pushes_per_hour"), F.col("baseline_pushes_per_hour")
    test = (base >= MIN_BASELINE_RATE) & (recent < base * 0.3)
    severity = (
        F.when(recent == 0, "high").when(recent < base * 0.15, "medium").otherwise("low")
    )
    return test, _record(
        as_of,
        "commit_drought",
        F.format_string("Commit activity dropped to %s/h", one_decimal(recent)),
        severity,
        F.format_string(
            f"PushEvents averaged %s/h over the last {window_hours:g}h, vs a %s/h baseline.",
            one_decimal(recent),
            one_decimal(base),
        ),
        {"recent_pushes_per_hour": recent, "baseline_pushes_per_hour": base},
    )


def activity_drought(rates: DataFrame, as_of: int, window_hours: float = 24) -> DataFrame:
    """Event rate below 0.3 x a baseline of at least one event per hour."""
    return _records(rates, _activity_drought(as_of, window_hours))


def detect_all(
    events: DataFrame,
    runs: DataFrame,
    as_of: int,
    repo: str | None = None,
    window_hours: float = windowed.WINDOW_HOURS,
    baseline_hours: float = windowed.BASELINE_HOURS,
) -> DataFrame:
    """Every rule; silent rules contribute nothing. Events are read once, runs once.

    Without `repo` the result covers the whole stream (repo NULL) and every
    single repository. With it, the event rules look at that repository only
    and the CI rule at all runs.
    """
    scoped = windowed.for_repo(events, repo)
    rates = windowed.failure_rates(runs, as_of, window_hours, baseline_hours)
    activity = windowed.event_windows(scoped, as_of, window_hours, baseline_hours)
    if repo:
        rates = rates.where(F.col("scope") == "all")
        activity = activity.where(F.col("scope") == "all").withColumn("repo_name", F.lit(repo))
    found = _records(activity, _merge_stretch(as_of, window_hours), _activity_drought(as_of, window_hours))
    return failure_spike(rates, as_of, window_hours).unionByName(found)


def paired(*metrics: DataFrame) -> DataFrame:
    """Metric tables side by side, one row per scope and repository.

    Each table has at most one row per scope and repository, so stacking them
    and taking the only value of each column is their full outer join in a
    single shuffle.
    """
    stacked = None
    for rows in metrics:
        stacked = (
            rows
            if stacked is None
            else stacked.unionByName(rows, allowMissingColumns=True)
        )
    values = [c for c in stacked.columns if c not in ("scope", "repo_name")]
    return stacked.groupBy("scope", "repo_name").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values]
    )


def health_signal(
    events: DataFrame,
    runs: DataFrame,
    as_of: int,
    repo: str | None = None,
    window_hours: float = windowed.WINDOW_HOURS,
    baseline_hours: float = windowed.BASELINE_HOURS,
) -> DataFrame:
    """CI stability, merge velocity and activity cadence, kept apart.

    No sample-size guard on the first two, unlike the rules.
    """
    scoped = windowed.for_repo(events, repo)
    rows = paired(
        windowed.failure_rates(runs, as_of, window_hours, baseline_hours),
        windowed.event_windows(scoped, as_of, window_hours, baseline_hours),
    )
    if repo:
        rows = rows.where(F.col("scope") == "all")
    rate = F.col("recent_failure_rate")
    recent, base = F.col("recent_avg_merge_hours"), F.col("baseline_avg_merge_hours")
    pushes = F.coalesce("recent_pushes_per_hour", F.lit(0.0))
    push_base = F.coalesce("baseline_pushes_per_hour", F.lit(0.0))
    ratio = F.try_divide(recent, base)
    fraction = F.try_divide(pushes, push_base)
    ci_status = F.when(rate.isNull(), "unknown").otherwise(
        descending_band(rate, [(0.35, "alert"), (0.15, "warn")], "ok")
    )
    pr_known = recent.isNotNull() & F.coalesce(base > 0, F.lit(False))
    pr_status = F.when(~pr_known, "unknown").otherwise(
        descending_band(ratio, [(3, "alert"), (1.5, "warn")], "ok")
    )
    busy = push_base >= MIN_BASELINE_RATE
    cadence_status = (
        F.when(~busy, "unknown")
        .when(fraction < 0.15, "alert")
        .when(fraction < 0.5, "warn")
        .otherwise("ok")
    )
    return rows.select(
        "scope",
        "repo_name",
        F.struct(
            ci_status.alias("status"),
            rate.alias("failure_rate"),
            F.when(rate.isNotNull(), F.col("baseline_failure_rate")).alias("baseline_failure_rate"),
            F.coalesce("recent_runs", F.lit(0)).alias("runs"),
        ).alias("ci_stability"),
        F.struct(
            pr_status.alias("status"),
            recent.alias("avg_merge_hours"),
            F.when(pr_known, base).alias("baseline_avg_merge_hours"),
        ).alias("pr_velocity"),
        F.struct(
            cadence_status.alias("status"),
            pushes.alias("pushes_per_hour"),
            F.when(busy, push_base).alias("baseline_pushes_per_hour"),
        ).alias("commit_cadence"),
        F.lit(SIGNAL_CAPTION).alias("caption"),
    )
