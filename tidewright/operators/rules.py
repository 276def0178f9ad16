"""Per-type validation and metrics as a table of column expressions.

Each event type names its checks in order (first failing one wins) and the
metrics of a valid event. `register` adds or replaces a type. Everything
becomes one `coalesce`/`when` expression, so there is no Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions import json_text as J
from tidewright.functions.binding import evaluated_once
from tidewright.functions.json_text import JsonObject
from tidewright.functions.text import VERSION_TAG, quoted
from tidewright.operators.flatten import repo_object

# Names that count as default branch, and accepted ref types.
DEFAULT_BRANCHES = ["main", "master", "trunk", "develop"]
REF_TYPES = ["branch", "tag", "repository"]

BAD_JSON = "not a JSON object"
NULL_REPO_NAME = "repo.name is null"
STANDARD_KEYS = ("id", "type", "actor", "repo")


@dataclass(frozen=True)
class TypeRules:
    """Checks and metrics of one event type.

    `fields` are the payload keys the rules read, `nested` the payload object
    they look into and `nested_fields` its keys. `checks` take the payload and
    the nested object and give (failed, reason) columns; `metrics` give name
    to column. `skip` marks valid events that are not stored; no rule sets it.
    """

    required: tuple[str, ...] = STANDARD_KEYS
    fields: tuple[str, ...] = ()
    nested: str | None = None
    nested_fields: tuple[str, ...] = ()
    checks: Callable[[JsonObject, JsonObject], list[tuple[Column, Column]]] = lambda pl, sub: []
    metrics: Callable[[JsonObject, JsonObject], dict[str, Column]] = lambda pl, sub: {}
    skip: Callable[[JsonObject, JsonObject], Column] = lambda pl, sub: F.lit(False)


def _need(pl: JsonObject, key: str) -> tuple[Column, Column]:
    """Payload text that must not be empty."""
    return ~J.present(pl.get(key)), F.lit(f"payload.{key} is missing")


def _inner(parent: JsonObject, key: str, inner_key: str) -> Column:
    """Text of a field two levels down, empty when it is missing."""
    text = parent.get(key)
    return JsonObject(J.as_fields(text, [inner_key]), text).get_or(inner_key, F.lit(""))


def _push_metrics(pl: JsonObject, sub: JsonObject) -> dict[str, Column]:
    branch = F.regexp_replace(
        F.regexp_replace(pl.get("ref"), "^refs/heads/", ""), "^refs/tags/", ""
    )
    commits = J.array_size(pl.get("commits"))
    return {
        "commit_count": commits,
        "branch": branch,
        "is_default_branch": branch.isin(DEFAULT_BRANCHES),
        "distinct_size": pl.get_or("distinct_size", commits.cast("string")),
    }


def _pull_request_metrics(pl: JsonObject, sub: JsonObject) -> dict[str, Column]:
    action = pl.get("action")
    return {
        "action": action,
        "pr_number": pl.get("number"),
        "is_merged": (action == "closed") & J.truthy(sub.get("merged")),
        "is_draft": J.truthy(sub.get("draft")),
        "target_branch": _inner(sub, "base", "ref"),
        "additions": sub.get("additions"),
        "deletions": sub.get("deletions"),
        "changed_files": sub.get("changed_files"),
    }


def _issue_metrics(pl: JsonObject, sub: JsonObject) -> dict[str, Column]:
    action = pl.get("action")
    return {
        "action": action,
        "issue_number": sub.get("number"),
        "is_closed": action == "closed",
        "label_count": J.array_size(sub.get("labels")),
        "comment_count": sub.get_or("comments", F.lit("0")),
    }


def _fork_metrics(pl: JsonObject, sub: JsonObject) -> dict[str, Column]:
    return {
        "fork_full_name": sub.get("full_name"),
        "fork_owner": _inner(sub, "owner", "login"),
        "is_private": J.truthy(sub.get("private")),
    }


def _create_checks(pl: JsonObject, sub: JsonObject) -> list[tuple[Column, Column]]:
    ref_type = pl.get("ref_type")
    shown = (
        F.when(ref_type.isNotNull(), quoted(ref_type))
        .when(pl.has("ref_type"), F.lit("None"))
        .otherwise(F.lit("''"))
    )
    known = F.coalesce(ref_type.isin(REF_TYPES), F.lit(False))
    return [(~known, F.concat(F.lit("payload.ref_type invalid or missing: "), shown))]


def _create_metrics(pl: JsonObject, sub: JsonObject) -> dict[str, Column]:
    ref_type = pl.get("ref_type")
    name = F.coalesce(pl.get("ref"), F.lit(""))
    return {
        "ref_type": ref_type,
        "ref_name": name,
        "is_tag": ref_type == "tag",
        "is_semver_tag": (ref_type == "tag") & name.rlike(VERSION_TAG),
    }


DEFAULT_RULES = TypeRules(required=("id", "type"))

RULES: dict[str, TypeRules] = {
    "PushEvent": TypeRules(
        fields=("ref", "commits", "distinct_size"),
        checks=lambda pl, sub: [_need(pl, "ref")],
        metrics=_push_metrics,
    ),
    "WatchEvent": TypeRules(
        fields=("action",),
        checks=lambda pl, sub: [_need(pl, "action")],
        metrics=lambda pl, sub: {"action": pl.get("action")},
    ),
    "PullRequestEvent": TypeRules(
        fields=("action", "number"),
        nested="pull_request",
        nested_fields=("merged", "draft", "base", "additions", "deletions", "changed_files"),
        checks=lambda pl, sub: [
            _need(pl, "action"),
            (pl.get("number").isNull(), F.lit("payload.number is missing")),
        ],
        metrics=_pull_request_metrics,
    ),
    "IssuesEvent": TypeRules(
        fields=("action",),
        nested="issue",
        nested_fields=("number", "labels", "comments"),
        checks=lambda pl, sub: [
            _need(pl, "action"),
            (sub.get("number").isNull(), F.lit("payload.issue.number is missing")),
        ],
        metrics=_issue_metrics,
    ),
    "ForkEvent": TypeRules(
        nested="forkee",
        nested_fields=("full_name", "owner", "private"),
        checks=lambda pl, sub: [
            _need(pl, "forkee"),
            (~J.present(sub.get("full_name")), F.lit("payload.forkee.full_name is missing")),
        ],
        metrics=_fork_metrics,
    ),
    "CreateEvent": TypeRules(
        fields=("ref", "ref_type"), checks=_create_checks, metrics=_create_metrics
    ),
}


def register(event_type: str, rules: TypeRules, table: dict[str, TypeRules] = RULES) -> None:
    table[event_type] = rules


def _reason(rules: TypeRules, pl: JsonObject, sub: JsonObject) -> Column:
    steps = [
        F.when(F.col(f"ev.{key}").isNull(), F.lit(f"required field missing: '{key}'"))
        for key in rules.required
    ]
    steps += [F.when(failed, reason) for failed, reason in rules.checks(pl, sub)]
    return F.coalesce(*steps, F.lit(None).cast("string"))


def _metric_map(metrics: dict[str, Column]) -> Column:
    if not metrics:
        return F.create_map().cast("map<string,string>")
    pairs = [c for name, col in metrics.items() for c in (F.lit(name), col.cast("string"))]
    return F.create_map(*pairs)


def _by_type(table: dict[str, TypeRules], pick: Callable[[TypeRules], Column]) -> Column:
    event_type = F.col("ev.type")
    chosen = None
    for name, rules in table.items():
        test = event_type == name
        chosen = F.when(test, pick(rules)) if chosen is None else chosen.when(test, pick(rules))
    fallback = pick(DEFAULT_RULES)
    return fallback if chosen is None else chosen.otherwise(fallback)


def _keys(names: list[str | None]) -> list[str]:
    """Distinct names in order; a struct needs at least one."""
    return list(dict.fromkeys(n for n in names if n)) or ["id"]


def validate(parsed: DataFrame, table: dict[str, TypeRules] = RULES) -> DataFrame:
    """Add `error_reason` (NULL when valid), `metrics` and `skipped`.

    Expects the columns of `parse_raw`. A null `repo.name` passes the checks of
    the types but cannot be stored, so it is rejected with its own reason.
    """
    payload_keys = _keys([k for r in table.values() for k in (*r.fields, r.nested)])
    nested_keys = _keys([k for r in table.values() for k in r.nested_fields])
    none = F.lit(None).cast("string")
    opened = evaluated_once(parsed, {"_pl": J.as_fields(F.col("ev.payload"), payload_keys)})
    payload = JsonObject(F.col("_pl"), F.col("ev.payload"))
    nested = _by_type(table, lambda r: payload.get(r.nested) if r.nested else none)
    opened = evaluated_once(opened, {"_text": nested})
    opened = evaluated_once(opened, {"_sub": J.as_fields(F.col("_text"), nested_keys)})
    sub = JsonObject(F.col("_sub"), F.col("_text"))

    raw_type = F.col("ev.type")
    label = F.when(raw_type.isin(list(table)), raw_type).otherwise(F.lit("default"))
    repo = repo_object()
    reason = F.coalesce(
        F.when(F.col("ev").isNull(), F.lit(BAD_JSON)),
        _by_type(table, lambda r: _reason(r, payload, sub)),
        F.when(repo.get("name").isNull() & repo.has("name"), F.lit(NULL_REPO_NAME)),
    )
    judged = evaluated_once(opened, {"_reason": reason})
    message = F.concat(
        F.lit("["),
        label,
        F.lit("] id="),
        quoted(F.coalesce("ev.id", F.lit(""))),
        F.lit(": "),
        F.col("_reason"),
    )
    valid = F.col("_reason").isNull()
    return judged.withColumns(
        {
            "error_reason": F.when(~valid, message),
            "metrics": F.when(
                valid, _by_type(table, lambda r: _metric_map(r.metrics(payload, sub)))
            ),
            "skipped": valid
            & F.coalesce(_by_type(table, lambda r: r.skip(payload, sub)), F.lit(False)),
        }
    ).drop("_pl", "_sub", "_text", "_reason")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_reason").isNull() & ~F.col("skipped"))


def dead_letters(validated: DataFrame, failed_at: Column, value: str = "value") -> DataFrame:
    """Rejected events in the dead-letter layout."""
    return validated.where(F.col("error_reason").isNotNull()).select(
        F.coalesce("ev.id", F.lit("")).alias("event_id"),
        F.coalesce("ev.type", F.lit("unknown")).alias("event_type"),
        "error_reason",
        F.coalesce(F.col(value), F.lit("")).alias("raw_json"),
        failed_at.alias("failed_at"),
    )


def emitted_metrics(validated: DataFrame) -> DataFrame:
    """Metrics of valid events, one row per event; `event_type` never in the map."""
    kept = accepted(validated).select(
        F.col("ev.id").alias("event_id"), F.col("ev.type").alias("event_type"), "metrics"
    )
    return evaluated_once(
        kept, {"metrics": F.map_filter("metrics", lambda k, _: k != "event_type")}
    )
