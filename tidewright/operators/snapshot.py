"""Evidence snapshot per repository, its text form and the anomaly built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.functions.bands import failure_severity
from tidewright.functions.text import one_decimal, percent
from tidewright.operators import windowed
from tidewright.operators.detection import at_time, paired

TOP_WORKFLOWS = 5
RECENT_MERGES = 10


def _in_order(rows: DataFrame, key: str, name: str, *columns: str) -> DataFrame:
    """Ranked rows of each key as one array; the rank bounds its length."""
    item = F.struct(F.col("rank"), *columns)
    return rows.groupBy(F.col(key).alias("repo_name")).agg(
        F.array_sort(F.collect_list(item)).alias(name)
    )


def _both_scopes(per_repo: DataFrame, overall: DataFrame, name: str) -> DataFrame:
    return per_repo.select(F.lit("repo").alias("scope"), "repo_name", name).unionByName(
        overall.select(F.lit("all").alias("scope"), "repo_name", name)
    )


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Rank an overall top-n, already limited."""
    return rows.withColumn("repo", F.lit(None).cast("string")).withColumn(
        "rank", F.row_number().over(Window.orderBy(*order))
    )


def evidence_snapshot(
    events: DataFrame,
    runs: DataFrame,
    as_of: int,
    repo: str | None = None,
    default_repo: str = "all repositories",
    window_hours: float = windowed.WINDOW_HOURS,
    baseline_hours: float = windowed.BASELINE_HOURS,
) -> DataFrame:
    """Rates with baselines, worst workflows and latest merges.

    One row for the whole stream and, without `repo`, one per repository.
    With `repo`, event evidence is limited to it while CI evidence is not.
    """
    scoped = windowed.for_repo(events, repo)
    metrics = paired(
        windowed.failure_rates(runs, as_of, window_hours, baseline_hours),
        windowed.push_rates(scoped, as_of, window_hours, baseline_hours),
    )
    workflow_cols = ("workflow_name", "failures", "runs", "failure_rate")
    # The lists of the whole stream come from those of the repositories: the sums and
    # the newest merges are computed once, and the plan reuses their exchanges.
    sums = windowed.workflow_sums(runs, as_of, window_hours)
    worst_repo = windowed.worst_workflows(sums, TOP_WORKFLOWS, per_repo=True)
    worst_all = _numbered(
        windowed.worst_workflows(sums, TOP_WORKFLOWS),
        F.desc("failure_rate"),
        F.desc("failures"),
        F.col("workflow_name"),
    )
    workflows = _both_scopes(
        _in_order(worst_repo, "repo", "failing_workflows", *workflow_cols),
        _in_order(worst_all, "repo", "failing_workflows", *workflow_cols),
        "failing_workflows",
    )
    merge_cols = ("pr_number", "title", "actor_login", "merged_at")
    merges_repo = windowed.newest_merges(scoped, as_of, window_hours, RECENT_MERGES)
    newest = (F.desc("merged_at"), F.col("event_id"))
    merges_all = _numbered(merges_repo.drop("rank").orderBy(*newest).limit(RECENT_MERGES), *newest)
    merges = _both_scopes(
        _in_order(merges_repo, "repo_name", "merged_prs", *merge_cols),
        _in_order(merges_all, "repo", "merged_prs", *merge_cols),
        "merged_prs",
    )
    rows = paired(metrics, workflows, merges)
    if repo:
        rows = rows.where(F.col("scope") == "all")
    return rows.select(
        "scope",
        F.coalesce(F.lit(repo).cast("string"), "repo_name", F.lit(default_repo)).alias("repo"),
        F.lit(float(window_hours)).alias("window_hours"),
        F.col("recent_failure_rate").alias("ci_failure_rate"),
        F.col("recent_runs").alias("ci_runs"),
        F.col("baseline_failure_rate").alias("ci_baseline_failure_rate"),
        "failing_workflows",
        "merged_prs",
        F.coalesce("recent_pushes_per_hour", F.lit(0.0)).alias("pushes_per_hour"),
        F.coalesce("baseline_pushes_per_hour", F.lit(0.0)).alias("baseline_pushes_per_hour"),
    )


def _hours(value: Column) -> Column:
    return F.format_string("%.0f", value)


def _workflow_line(w: Column) -> Column:
    return F.format_string(
        "  - %s: %d/%d failed (%s)",
        w.getField("workflow_name"),
        w.getField("failures"),
        w.getField("runs"),
        percent(w.getField("failure_rate")),
    )


def _merge_line(p: Column) -> Column:
    return F.concat(
        F.lit("  - #"),
        F.coalesce(p.getField("pr_number"), F.lit("None")),
        F.lit(" "),
        F.coalesce(p.getField("title"), F.lit("None")),
        F.lit(" (@"),
        F.coalesce(p.getField("actor_login"), F.lit("None")),
        F.lit(")"),
    )


def snapshot_text() -> Column:
    """The snapshot as lines of text; missing data is stated plainly."""
    rate, base = F.col("ci_failure_rate"), F.col("ci_baseline_failure_rate")
    base_text = F.when(base.isNotNull(), F.format_string(" (baseline %s)", percent(base)))
    ci = F.when(rate.isNull(), F.lit("CI: no workflow-run data in the window")).otherwise(
        F.concat(
            F.format_string("CI failure rate: %s over %d runs", percent(rate), F.col("ci_runs")),
            F.coalesce(base_text, F.lit("")),
        )
    )
    has_workflows = F.coalesce(F.size("failing_workflows"), F.lit(0)) > 0
    workflows = F.when(
        has_workflows,
        F.concat_ws(
            "\n",
            F.lit("Most-failing workflows:"),
            F.transform("failing_workflows", _workflow_line),
        ),
    )
    n_merges = F.coalesce(F.size("merged_prs"), F.lit(0))
    merges = F.when(
        n_merges > 0,
        F.concat_ws(
            "\n",
            F.format_string("PRs merged in the window (%d most recent):", n_merges),
            F.transform("merged_prs", _merge_line),
        ),
    ).otherwise(F.lit("PRs merged in the window: none observed in the stream yet"))
    push_base = F.col("baseline_pushes_per_hour")
    pushes = F.concat(
        F.format_string("Push rate: %s/h", one_decimal(F.col("pushes_per_hour"))),
        F.when(
            push_base > 0, F.format_string(" (baseline %s/h)", one_decimal(push_base))
        ).otherwise(F.lit("")),
    )
    head = F.format_string(
        "Live pipeline snapshot — %s, last %sh (computed, not generated)",
        F.col("repo"),
        _hours(F.col("window_hours")),
    )
    return F.concat_ws("\n", head, ci, workflows, merges, pushes)


def snapshot_anomaly(snapshots: DataFrame, as_of: int) -> DataFrame:
    """An anomaly stating the current CI state; none without CI data.

    The id depends on repository and time, so the same snapshot has one id.
    """
    rate = F.col("ci_failure_rate")
    worst = F.try_element_at("failing_workflows", F.lit(1))
    worst_text = F.when(
        worst.isNotNull(),
        F.format_string(
            " Worst workflow: %s (%d/%d failed).",
            worst.getField("workflow_name"),
            worst.getField("failures"),
            worst.getField("runs"),
        ),
    ).otherwise(F.lit(""))
    digest = F.substring(F.sha1(F.concat_ws(":", "scope", "repo", F.lit(str(as_of)))), 1, 8)
    return snapshots.where(rate.isNotNull() & (F.col("ci_runs") > 0)).select(
        F.concat(F.lit("snap-"), digest).alias("anomaly_id"),
        F.lit("ci_failure_spike").alias("type"),
        F.format_string(
            "CI snapshot: %s failure rate (%d runs)", percent(rate), F.col("ci_runs")
        ).alias("title"),
        failure_severity(rate).alias("severity"),
        F.format_string(
            "Manually triggered snapshot of %s's current CI state over the last %sh — "
            "real data, not a detected anomaly.%s",
            F.col("repo"),
            _hours(F.col("window_hours")),
            worst_text,
        ).alias("description"),
        F.create_map(
            F.lit("recent_failure_rate"),
            rate,
            F.lit("baseline_failure_rate"),
            F.col("ci_baseline_failure_rate"),
            F.lit("recent_runs"),
            F.col("ci_runs").cast("double"),
        ).alias("metric"),
        F.col("repo"),
        at_time(as_of).alias("detected_at"),
        F.lit(True).alias("is_demo"),
    )


def freshness(events: DataFrame, runs: DataFrame, cases: DataFrame) -> DataFrame:
    """Newest event, newest CI run, case count and readiness in one row."""
    latest_event = events.agg(F.max("created_at").alias("latest_event_at"))
    return latest_event.select(
        "latest_event_at",
        runs.agg(F.max("created_at")).scalar().alias("latest_ci_run_at"),
        cases.agg(F.count("*")).scalar().alias("case_count"),
    ).withColumn("kb_ready", F.col("case_count") > 0)
