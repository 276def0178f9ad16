"""Recent-versus-baseline metrics for every repository and for the whole stream.

Both windows come from one scan: rows of the whole span are reduced to partial
sums per repository, and the overall row is a roll-up of those partial sums.
`scope` is `all` or `repo`; `repo_name` is NULL on the `all` row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions import json_text as J
from tidewright.functions.binding import evaluated_once
from tidewright.functions.time_bounds import hours_between, is_recent, window
from tidewright.operators.ranking import top_k

# Default windows and the conclusions that count as decisive.
WINDOW_HOURS = 24
BASELINE_HOURS = 168
DECISIVE = ["success", "failure"]


def for_repo(rows: DataFrame, repo: str | None, column: str = "repo_name") -> DataFrame:
    """Optional entity filter."""
    return rows if not repo else rows.where(F.col(column) == repo)


def _partial(name: str, test: Column, value: Column | None = None) -> list[Column]:
    """Count (and sum) of the rows of one window, mergeable by `sum`."""
    if value is None:
        return [F.count_if(test).alias(name)]
    return [
        F.sum(F.when(test, value)).alias(f"{name}_sum"),
        F.count_if(test & value.isNotNull()).alias(f"{name}_n"),
    ]


def per_repo_and_total(rows: DataFrame, partials: list[Column]) -> DataFrame:
    """Partial sums per repository plus one overall row.

    An empty input still gives the overall row, with zero counts.
    """
    per_repo = rows.groupBy("repo_name").agg(*partials)
    names = [c for c in per_repo.columns if c != "repo_name"]
    sums = [
        (F.sum(c) if c.endswith("_sum") else F.coalesce(F.sum(c), F.lit(0))).alias(c)
        for c in names
    ]
    repos = per_repo.select(F.lit("repo").alias("scope"), "repo_name", *names)
    total = per_repo.agg(*sums).select(
        F.lit("all").alias("scope"), F.lit(None).cast("string").alias("repo_name"), *names
    )
    return repos.unionByName(total)


def _span(df: DataFrame, as_of: int, window_hours: float, baseline_hours: float):
    span = window(df, "created_at", as_of, baseline_hours)
    recent = is_recent(df, "created_at", as_of, window_hours)
    return span.withColumn("_recent", recent)


def _ratio(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def decisive(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("conclusion").isin(DECISIVE))


def failure_rates(
    runs: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    baseline_hours: float = BASELINE_HOURS,
) -> DataFrame:
    """Failure rate and run count, recent and baseline."""
    failed = F.col("conclusion") == "failure"
    recent = F.col("_recent")
    rows = _span(decisive(runs), as_of, window_hours, baseline_hours)
    sums = per_repo_and_total(
        rows.withColumnRenamed("repo", "repo_name"),
        _partial("recent_runs", recent)
        + _partial("recent_failures", recent & failed)
        + _partial("baseline_runs", ~recent)
        + _partial("baseline_failures", ~recent & failed),
    )
    return sums.select(
        "scope",
        "repo_name",
        _ratio(F.col("recent_failures"), F.col("recent_runs")).alias("recent_failure_rate"),
        "recent_runs",
        _ratio(F.col("baseline_failures"), F.col("baseline_runs")).alias(
            "baseline_failure_rate"
        ),
        "baseline_runs",
    )


def workflow_sums(runs: DataFrame, as_of: int, window_hours: float = WINDOW_HOURS) -> DataFrame:
    """Failures and decisive runs of every workflow of every repository in the window."""
    return (
        window(decisive(runs), "created_at", as_of, window_hours)
        .groupBy("repo", "workflow_name")
        .agg(F.count_if(F.col("conclusion") == "failure").alias("failures"), F.count("*").alias("runs"))
    )


def worst_workflows(sums: DataFrame, limit: int = 5, min_runs: int = 2, per_repo: bool = False) -> DataFrame:
    """Workflows by failure rate, from their sums; single runs are left out."""
    if not per_repo:
        sums = sums.groupBy("workflow_name").agg(F.sum("failures").alias("failures"), F.sum("runs").alias("runs"))
    rates = sums.where(F.col("runs") >= min_runs).withColumn(
        "failure_rate", _ratio(F.col("failures"), F.col("runs"))
    )
    order = (F.desc("failure_rate"), F.desc("failures"), "workflow_name")
    if per_repo:
        return top_k(rates, "repo", limit, *order)
    return rates.orderBy(*order).limit(limit)


def failing_workflows(
    runs: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    limit: int = 5,
    min_runs: int = 2,
    per_repo: bool = False,
) -> DataFrame:
    """Workflows by failure rate in the window; single runs are left out."""
    return worst_workflows(workflow_sums(runs, as_of, window_hours), limit, min_runs, per_repo)


# The payload fields the merge metrics read.
_PR_PAYLOAD = (
    "struct<action:string,number:string,"
    "pull_request:struct<title:string,merged:string,created_at:string,merged_at:string>>"
)


def merged_pull_requests(events: DataFrame) -> DataFrame:
    """Closed and merged pull requests with their parsed payload `pr`."""
    prs = events.where(F.col("event_type") == "PullRequestEvent")
    parsed = evaluated_once(prs, {"pr": F.from_json("payload_json", _PR_PAYLOAD)})
    return parsed.where(
        (F.col("pr.action") == "closed") & (F.col("pr.pull_request.merged") == "true")
    )


def merge_times(
    events: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    baseline_hours: float = BASELINE_HOURS,
) -> DataFrame:
    """Mean open-to-merge hours and merged count, recent and baseline.

    The count takes every merged row, also those without usable times.
    """
    recent = F.col("_recent")
    rows = merged_pull_requests(_span(events, as_of, window_hours, baseline_hours))
    times = rows.select(
        "repo_name",
        "_recent",
        hours_between(
            J.iso_timestamp(F.col("pr.pull_request.created_at")),
            J.iso_timestamp(F.col("pr.pull_request.merged_at")),
        ).alias("hours"),
    )
    sums = per_repo_and_total(
        times,
        _partial("recent_merged", recent)
        + _partial("recent", recent, F.col("hours"))
        + _partial("baseline_merged", ~recent)
        + _partial("baseline", ~recent, F.col("hours")),
    )
    return sums.select(
        "scope",
        "repo_name",
        _ratio(F.col("recent_sum"), F.col("recent_n")).alias("recent_avg_merge_hours"),
        "recent_merged",
        _ratio(F.col("baseline_sum"), F.col("baseline_n")).alias("baseline_avg_merge_hours"),
        "baseline_merged",
    )


def push_rates(
    events: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    baseline_hours: float = BASELINE_HOURS,
    event_type: str = "PushEvent",
) -> DataFrame:
    """Events per hour, recent and baseline; zero, never NULL, without rows."""
    recent = F.col("_recent")
    rows = _span(
        events.where(F.col("event_type") == event_type), as_of, window_hours, baseline_hours
    )
    sums = per_repo_and_total(
        rows, _partial("recent_pushes", recent) + _partial("baseline_pushes", ~recent)
    )
    return sums.select(
        "scope",
        "repo_name",
        (F.col("recent_pushes") / F.lit(float(window_hours))).alias("recent_pushes_per_hour"),
        "recent_pushes",
        (F.col("baseline_pushes") / F.lit(float(baseline_hours - window_hours))).alias(
            "baseline_pushes_per_hour"
        ),
        "baseline_pushes",
    )


def event_windows(
    events: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    baseline_hours: float = BASELINE_HOURS,
) -> DataFrame:
    """Columns of `merge_times` and `push_rates` side by side, from one scan of the events.

    A repository has a row when it has a merge or a push in the span.
    """
    is_push, recent = F.col("event_type") == "PushEvent", F.col("_recent")
    span = _span(
        events.where(F.col("event_type").isin("PushEvent", "PullRequestEvent")),
        as_of, window_hours, baseline_hours,
    )
    parsed = evaluated_once(span, {"pr": F.from_json(F.when(~is_push, F.col("payload_json")), _PR_PAYLOAD)})
    merged = F.coalesce((F.col("pr.action") == "closed") & (F.col("pr.pull_request.merged") == "true"), F.lit(False))
    hours = hours_between(
        J.iso_timestamp(F.col("pr.pull_request.created_at")), J.iso_timestamp(F.col("pr.pull_request.merged_at"))
    )
    rows = parsed.select("repo_name", "_recent", is_push.alias("_push"), merged.alias("_merged"), hours.alias("hours")).where(
        "_push or _merged"
    )
    push, merge = F.col("_push"), F.col("_merged")
    sums = per_repo_and_total(
        rows,
        _partial("recent_merged", recent & merge)
        + _partial("recent", recent & merge, F.col("hours"))
        + _partial("baseline_merged", ~recent & merge)
        + _partial("baseline", ~recent & merge, F.col("hours"))
        + _partial("recent_pushes", recent & push)
        + _partial("baseline_pushes", ~recent & push),
    )
    return sums.select(
        "scope",
        "repo_name",
        _ratio(F.col("recent_sum"), F.col("recent_n")).alias("recent_avg_merge_hours"),
        "recent_merged",
        _ratio(F.col("baseline_sum"), F.col("baseline_n")).alias("baseline_avg_merge_hours"),
        "baseline_merged",
        (F.col("recent_pushes") / F.lit(float(window_hours))).alias("recent_pushes_per_hour"),
        "recent_pushes",
        (F.col("baseline_pushes") / F.lit(float(baseline_hours - window_hours))).alias("baseline_pushes_per_hour"),
        "baseline_pushes",
    )


def newest_merges(
    events: DataFrame, as_of: int, window_hours: float = WINDOW_HOURS, limit: int = 10
) -> DataFrame:
    """The last pull requests merged in each repository, with their rank and event id."""
    return top_k(_merges(events, as_of, window_hours), "repo_name", limit, F.desc("merged_at"), "event_id")


def _merges(events: DataFrame, as_of: int, window_hours: float) -> DataFrame:
    return merged_pull_requests(window(events, "created_at", as_of, window_hours)).select(
        "repo_name",
        "event_id",
        F.col("pr.number").alias("pr_number"),
        F.col("pr.pull_request.title").alias("title"),
        "actor_login",
        F.col("created_at").alias("merged_at"),
    )


def merged_recent(
    events: DataFrame,
    as_of: int,
    window_hours: float = WINDOW_HOURS,
    limit: int = 10,
    per_repo: bool = False,
) -> DataFrame:
    """Pull requests merged in the window, newest first."""
    if per_repo:
        return newest_merges(events, as_of, window_hours, limit).drop("event_id")
    rows = _merges(events, as_of, window_hours)
    return rows.orderBy(F.desc("merged_at"), "event_id").limit(limit).select(
        "pr_number", "title", "actor_login", "merged_at"
    )
