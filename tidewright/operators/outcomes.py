"""Historical outcomes, evidence text and context of matched cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.binding import let
from tidewright.functions.json_text import strict_fields
from tidewright.functions.text import TRIMMED_SNIPPET_CHARS, listed, snippet, strip_whitespace
from tidewright.operators.skew import skew_safe_lookup
from tidewright.session import written

# Label parts that tell severity or priority.
SEVERITY_MARKERS = ["severity", "priority", "p0", "p1", "hotfix", "critical"]

OUTPUT_KEYS = ["summary", "suggested_actions", "confidence"]

BLOCK_SEPARATOR = "\n\n---\n\n"
NO_CASES = "(no similar cases retrieved)"


def is_severity_label(label: Column) -> Column:
    """A lower-cased label that holds any marker."""
    markers = F.array(*[F.lit(m) for m in SEVERITY_MARKERS])
    return F.exists(markers, lambda marker: F.contains(label, marker))


def severity_labels(rows: DataFrame, key: str, labels: str = "labels") -> DataFrame:
    """Distinct lower-cased severity labels per key, sorted.

    Labels are filtered and made distinct before they are gathered.
    """
    return (
        rows.select(key, F.explode(labels).alias("_label"))
        .select(key, F.lower("_label").alias("_label"))
        .where(is_severity_label(F.col("_label")))
        .distinct()
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("_label")).alias("severity_labels"))
    )


def _matched(matches: DataFrame, cases: DataFrame) -> DataFrame:
    """Case rows per query; unknown case ids fall away, repeats count once."""
    pairs = matches.select("query_id", "case_id").distinct()
    wanted = cases.select(
        "case_id", "kind", "was_reverted", "time_to_resolve_hours", "labels"
    )
    facts = written(pairs, "outcome-pairs")
    # Narrow rows without texts, read by the numbers and by the labels.
    return written(skew_safe_lookup(facts, wanted, "case_id"), "outcome-cases")


def estimate_outcomes(
    queries: DataFrame, matches: DataFrame, cases: DataFrame
) -> DataFrame:
    """Outcome estimate per query; no matched case gives zeros and NULLs."""
    rows = _matched(matches, cases)
    is_pr = F.col("kind") == "pr"
    numbers = rows.groupBy("query_id").agg(
        F.count("*").alias("sample_size"),
        F.count_if(is_pr).alias("pr_count"),
        F.avg(
            F.when(is_pr, F.when(F.col("was_reverted"), F.lit(1.0)).otherwise(F.lit(0.0)))
        ).alias("revert_rate"),
        F.avg("time_to_resolve_hours").alias("avg_time_to_resolve_hours"),
    )
    labels = severity_labels(rows, "query_id")
    return (
        queries.select("query_id")
        .join(numbers, "query_id", "left")
        .join(labels, "query_id", "left")
        .select(
            "query_id",
            F.coalesce("sample_size", F.lit(0)).alias("sample_size"),
            F.coalesce("pr_count", F.lit(0)).alias("pr_count"),
            "revert_rate",
            "avg_time_to_resolve_hours",
            F.coalesce("severity_labels", F.array().cast("array<string>")).alias(
                "severity_labels"
            ),
        )
    )


def estimate_for_ids(cases: DataFrame, ids: DataFrame) -> DataFrame:
    """Outcome estimate of one set of case ids."""
    one = ids.select(F.lit(0).alias("query_id"), "case_id")
    query = cases.sparkSession.range(1).select(F.lit(0).alias("query_id"))
    return estimate_outcomes(query, one, cases).drop("query_id")


def evidence_block() -> Column:
    """The text of one retrieved case."""
    return F.concat(
        F.lit("["),
        F.col("case_id"),
        F.lit("] "),
        F.col("title"),
        F.lit("\nlabels: "),
        listed(F.col("labels")),
        F.lit(" | reverted: "),
        F.when(F.col("was_reverted"), "yes").otherwise("no"),
        F.lit(" | similarity: "),
        F.col("similarity_band"),
        F.lit("\n"),
        F.coalesce("body_snippet", F.lit("(no body)")),
    )


def evidence_blocks(found: DataFrame) -> DataFrame:
    """Blocks per query in rank order; the top-k bounds the array."""
    item = F.struct("rank", evidence_block().alias("text"))
    return found.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda b: b.getField("text")).alias(
            "blocks"
        )
    )


def with_live_block(blocks: Column, live: Column) -> Column:
    """The live evidence, where there is any, ahead of the retrieved blocks."""
    head = F.concat(F.lit("[live pipeline snapshot]\n"), live)
    return F.when(
        live.isNotNull() & (live != ""), F.concat(F.array(head), blocks)
    ).otherwise(blocks)


def context_text(subject: Column, blocks: Column, live: Column | None = None) -> Column:
    """Subject, live evidence and case blocks as one text."""
    cases = F.coalesce(F.nullif(F.array_join(blocks, BLOCK_SEPARATOR), F.lit("")), F.lit(NO_CASES))
    sections = [F.concat(F.lit("## Subject\n"), subject)]
    if live is not None:
        sections.append(
            F.when(
                live.isNotNull() & (live != ""),
                F.concat(
                    F.lit(
                        "## Live pipeline evidence (computed from current stream/CI data — "
                        "cite specific workflows and PR numbers from here)\n"
                    ),
                    live,
                ),
            )
        )
    sections.append(F.concat(F.lit("## Retrieved similar historical cases\n"), cases))
    return F.concat_ws("\n\n", *sections)


def trimmed_cases(found: DataFrame) -> DataFrame:
    """Retrieved cases in their short form, in rank order per query."""
    item = F.struct(
        "rank",
        "case_id",
        "kind",
        "title",
        "url",
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        "similarity_band",
        F.coalesce("was_reverted", F.lit(False)).alias("was_reverted"),
        "time_to_resolve_hours",
        snippet(F.col("body_snippet"), TRIMMED_SNIPPET_CHARS).alias("snippet"),
    )
    return found.groupBy("query_id").agg(
        F.array_sort(F.collect_list(item)).alias("similar_cases")
    )


def parse_generated(raw: Column) -> Column:
    """Model-output text to summary, actions and confidence.

    Takes the text from the first `{` to the last `}`, fenced or not. Text that
    is no such JSON is kept as the summary with low confidence.
    """
    body = F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit(""))
    none = F.array().cast("array<string>")

    def read(fields: Column) -> Column:
        ok = fields.isNotNull()
        actions = F.from_json(fields.getField("suggested_actions"), "array<string>")
        return F.struct(
            F.when(ok, strip_whitespace(F.coalesce(fields.getField("summary"), F.lit(""))))
            .otherwise(strip_whitespace(raw))
            .alias("summary"),
            F.when(ok, F.coalesce(actions, none)).otherwise(none).alias("suggested_actions"),
            F.when(ok, F.lower(F.coalesce(fields.getField("confidence"), F.lit("low"))))
            .otherwise(F.lit("low"))
            .alias("confidence"),
        )

    return let(strict_fields(body, OUTPUT_KEYS), read)
