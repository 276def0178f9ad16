"""Landed API pages (JSON text, one page or item per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions import json_text as J
from tidewright.operators.ranking import top_k
from tidewright.sources.sinks import overwrite

_RUN_PAGE = (
    "struct<workflow_runs:array<struct<"
    "id:bigint,name:string,status:string,conclusion:string,created_at:string>>>"
)


def newest(rows: DataFrame, by: str, limit: int | None, repo: Column, *ties: str) -> DataFrame:
    """The newest rows of each repository by a time column, or all of them without a limit.

    Ranked per repository, so a busy one pushes no other out.
    """
    if limit is None:
        return rows
    return top_k(
        rows.withColumn("_repo", repo), "_repo", limit, F.col(by).desc_nulls_last(), *ties, name="_rank"
    ).drop("_repo", "_rank")


def ci_runs(pages: DataFrame, repo: str | Column, max_runs: int | None = None) -> DataFrame:
    """Workflow-run pages to CI rows; with `max_runs`, the newest of each repository."""
    repo_col = F.lit(repo) if isinstance(repo, str) else repo
    runs = pages.select(
        repo_col.alias("repo"),
        F.explode(F.from_json("value", _RUN_PAGE).getField("workflow_runs")).alias("run"),
    ).select(
        F.col("run.id").alias("run_id"),
        "repo",
        F.col("run.name").alias("workflow_name"),
        F.col("run.status").alias("status"),
        F.col("run.conclusion").alias("conclusion"),
        J.iso_timestamp(F.col("run.created_at")).alias("created_at"),
    )
    return newest(runs, "created_at", max_runs, F.col("repo"), "run_id", "workflow_name")


def newest_items(items: DataFrame, max_items: int | None = None, repo: Column | None = None) -> DataFrame:
    """Landed issues and pull requests; with `max_items`, the most recently updated of each repository.

    Without `repo` all items belong to one. Ties go to the smaller number, then
    by the text.
    """
    stamped = items.withColumns(
        {
            "_updated": J.iso_timestamp(F.get_json_object("value", "$.updated_at")),
            "_number": F.get_json_object("value", "$.number").cast("bigint"),
        }
    )
    own = F.lit("") if repo is None else repo
    return newest(stamped, "_updated", max_items, own, "_number", "value").drop("_updated", "_number")


def write_ci_runs(runs: DataFrame, path: str) -> None:
    overwrite(runs, path)
