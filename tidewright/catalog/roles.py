"""Developer-activity roles of the test tables.

The tables are a star schema plus an event log. These expressions give them
the shape of the engine's own tables, always over every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.functions.binding import evaluated_once
from tidewright.operators import cases as C

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Event types and CI conclusions that stand for the log's types.
TYPE_OF = {
    "click": "PushEvent",
    "view": "PullRequestEvent",
    "purchase": "IssuesEvent",
    "signup": "WatchEvent",
}
CONCLUSION_OF = {
    "error": "failure",
    "purchase": "success",
    "click": "success",
    "view": "cancelled",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(column: Column, names: dict[str, str], default: Column) -> Column:
    chosen = None
    for source, target in names.items():
        test = column == source
        chosen = F.when(test, target) if chosen is None else chosen.when(test, target)
    return chosen.otherwise(default)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log with its number `k` and the derived names."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = table(spark, sf_dir, "events").withColumn("k", k)
    other = F.when(F.col("k") % 2 == 0, "CreateEvent").otherwise("ForkEvent")
    return rows.select(
        F.col("event_id").alias("number"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("log_type"),
        _pick(F.col("event_type"), TYPE_OF, other).alias("event_type"),
        "user_id",
        F.concat(F.lit("user-"), F.col("user_id")).alias("actor_login"),
        (F.col("k") % 10).alias("repo_id"),
        F.concat(F.lit("org/repo-"), F.col("k") % 10).alias("repo_name"),
        F.col("ts").alias("created_at"),
        F.timestamp_add(
            "MICROSECOND", F.round(F.col("value") * 1e6).cast("bigint"), F.col("ts")
        ).alias("ingested_at"),
        "value",
        "k",
    )


def _payload() -> Column:
    """Payload object text per event type; some lack what the rules require."""
    k, number = F.col("k"), F.col("number")
    ref = (
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 1, "refs/heads/main")
        .when(k % 10 == 2, "refs/tags/v1")
        .otherwise(F.concat(F.lit("refs/heads/topic-"), k))
    )
    push = F.struct(
        ref.alias("ref"),
        k.alias("size"),
        F.when(k % 6 != 0, F.floor(k / 2)).alias("distinct_size"),
        F.when(
            k % 9 != 0,
            F.array_repeat(F.struct(F.col("event_id").alias("sha")), (k % 4).cast("int")),
        ).alias("commits"),
    )
    opened = F.timestamp_add(
        "SECOND", -F.round(F.col("value") * 3600).cast("bigint"), F.col("created_at")
    )
    pull_request = F.struct(
        F.when(k % 2 == 0, "closed").otherwise("opened").alias("action"),
        F.when(k % 10 != 9, number).alias("number"),
        F.struct(
            F.concat(F.lit("Change "), number).alias("title"),
            (k % 4 == 0).alias("merged"),
            (k % 3 == 0).alias("draft"),
            k.alias("additions"),
            F.floor(k / 2).alias("deletions"),
            (k % 5).alias("changed_files"),
            F.struct(F.lit("main").alias("ref")).alias("base"),
            _iso(opened).alias("created_at"),
            _iso(F.col("created_at")).alias("merged_at"),
        ).alias("pull_request"),
    )
    issue = F.struct(
        F.when(k % 5 == 1, "closed").when(k % 5 > 1, "opened").alias("action"),
        F.struct(
            F.when(k % 10 != 8, number).alias("number"),
            F.array_repeat(F.struct(F.lit("bug").alias("name")), (k % 3).cast("int")).alias(
                "labels"
            ),
            F.when(k % 7 != 0, k).alias("comments"),
        ).alias("issue"),
    )
    watch = F.struct(F.when(k % 10 == 7, "").otherwise("started").alias("action"))
    tag = F.when(k % 3 == 0, F.concat(F.lit("v1."), k)).otherwise(F.concat(F.lit("release-"), k))
    create = F.struct(
        F.when(k % 8 == 0, "branch")
        .when(k % 8 == 2, "tag")
        .when(k % 8 == 4, "repository")
        .when(k % 16 == 6, "other")
        .alias("ref_type"),
        tag.alias("ref"),
    )
    fork = F.struct(
        F.when(
            k % 10 != 5,
            F.struct(
                F.when(k % 10 == 3, "")
                .otherwise(F.concat(F.lit("fork/repo-"), k))
                .alias("full_name"),
                F.struct(F.col("actor_login").alias("login")).alias("owner"),
                (k % 4 == 1).alias("private"),
            ),
        ).alias("forkee")
    )
    shapes = {
        "PushEvent": push,
        "PullRequestEvent": pull_request,
        "IssuesEvent": issue,
        "WatchEvent": watch,
        "CreateEvent": create,
    }
    text = None
    for name, shape in shapes.items():
        test = F.col("event_type") == name
        text = F.when(test, F.to_json(shape)) if text is None else text.when(test, F.to_json(shape))
    return text.otherwise(F.to_json(fork))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role of the flat event table, without payloads."""
    return _numbered(spark, sf_dir)


def payload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role of the flat event table."""
    return evaluated_once(_numbered(spark, sf_dir), {"payload_json": _payload()})


def ci_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role of the CI-run table."""
    none = F.lit(None).cast("string")
    return _numbered(spark, sf_dir).select(
        F.col("number").alias("run_id"),
        F.col("repo_name").alias("repo"),
        F.concat(F.lit("wf-"), F.col("user_id")).alias("workflow_name"),
        F.lit("completed").alias("status"),
        _pick(F.col("log_type"), CONCLUSION_OF, none).alias("conclusion"),
        "created_at",
    )


def _envelope() -> Column:
    """Top-level fields of a raw event but for the payload."""
    return F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("type"),
            F.when(
                F.col("user_id") % 50 != 49,
                F.struct(F.col("user_id").alias("id"), F.col("actor_login").alias("login")),
            ).alias("actor"),
            F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
            F.lit(True).alias("public"),
            F.when(F.col("k") == 77, "not-a-date")
            .otherwise(_iso(F.col("created_at")))
            .alias("created_at"),
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event texts: `value`, with `position` as arrival order.

    Some lack an actor, have an unusable time or are cut off.
    """
    rows = payload_events(spark, sf_dir)
    payload = F.col("payload_json")
    rows = evaluated_once(rows, {"head": _envelope()})
    head = F.col("head")
    whole = F.concat(
        F.substring(head, 1, F.length(head) - 1), F.lit(',"payload":'), payload, F.lit("}")
    )
    cut = F.when(F.col("number") % 97 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    slim = rows.select("head", "payload_json", "number", F.col("number").alias("position"))
    return evaluated_once(slim, {"value": cut}).select("value", "position")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed issues and pull requests from the documents."""
    n = F.col("doc_id")
    first_line = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    is_pr = n % 3 != 0
    title = (
        F.when(n % 10 == 0, F.concat(F.lit("Revert change #"), n - 3))
        .when(n % 10 == 5, F.lit("revert: undo"))
        .otherwise(first_line)
    )
    body = (
        F.when(n % 10 == 5, F.concat(F.lit("Reverts org/repo#"), n - 4, F.lit("\n"), F.col("text")))
        .when(n % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("text"))
    )
    opened = F.timestamp_add("HOUR", n, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    closed = F.timestamp_add("MINUTE", F.col("n_chars"), opened)
    labels = F.array(
        F.struct(F.concat(F.lit("Severity/"), F.col("lang")).alias("name")),
        F.struct(F.col("source").alias("name")),
        F.struct(F.when(n % 5 == 0, "P0").otherwise("kind/change").alias("name")),
    )
    item = F.struct(
        n.alias("number"),
        title.alias("title"),
        body.alias("body"),
        F.concat(F.lit("https://example.org/"), n).alias("html_url"),
        labels.alias("labels"),
        _iso(opened).alias("created_at"),
        F.when(n % 7 != 0, _iso(closed)).alias("closed_at"),
        F.when(is_pr, F.struct(F.lit("https://example.org").alias("url"))).alias("pull_request"),
    )
    rows = table(spark, sf_dir, "documents")
    return evaluated_once(rows, {"value": F.to_json(item)}).select(
        "value", n.alias("position")
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.build_cases(items(spark, sf_dir), "position")


def vectors(spark: SparkSession, sf_dir: str, key: str = "case_id") -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias(key), "embedding")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases that have a vector of the same number."""
    numbered = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("number"), "embedding", "label"
    )
    known = cases(spark, sf_dir)
    embeddings = known.select("case_id", "number").join(numbered, "number").select(
        "case_id", "embedding"
    )
    return C.searchable(known, embeddings)


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a query with a short text."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"),
        F.concat(F.lit("subject "), F.col("vec_id")).alias("subject"),
        "embedding",
    )


def generated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as model output: plain, fenced, off-format."""
    said = F.to_json(
        F.struct(
            F.col("text").alias("summary"),
            F.array(F.lit("Review"), F.col("role")).alias("suggested_actions"),
            F.when(F.col("turn") % 2 == 0, "HIGH").otherwise("Medium").alias("confidence"),
        )
    )
    raw = (
        F.when(F.col("turn") % 3 == 0, said)
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("```json\n"), said, F.lit("\n```")))
        .otherwise(F.concat(F.lit("  "), F.col("text"), F.lit(" {broken\n")))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("raw"))
