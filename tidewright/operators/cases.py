"""Issue and pull-request cases with revert linkage."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions import json_text as J
from tidewright.functions.binding import evaluated_once
from tidewright.functions.hash_vectors import hash_vector
from tidewright.functions.text import (
    is_revert_title,
    joined_subject,
    reverted_number,
    snippet,
)
from tidewright.functions.time_bounds import hours_between
from tidewright.schemas import CASE_SCHEMA
from tidewright.session import written

# The batch embedder travels with its code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMNS = [f.name for f in CASE_SCHEMA.fields]
# The keys read from an issue or pull request.
ITEM_KEYS = [
    "number", "title", "body", "html_url", "labels", "created_at", "closed_at", "pull_request",
]
_LABELS = "array<struct<name:string>>"


def case_id(kind: Column, number: Column) -> Column:
    return F.concat(kind, F.lit("-"), number.cast("string"))


def label_names(labels: Column) -> Column:
    """Names of an array of label objects; no array gives an empty list."""
    names = F.transform(F.from_json(labels, _LABELS), lambda label: label.getField("name"))
    return F.coalesce(names, F.array().cast("array<string>"))


def flatten_items(items: DataFrame, value: str = "value") -> DataFrame:
    """Raw item JSON to case columns; the item is a PR when it names one."""
    parsed = evaluated_once(items, {"_it": J.strict_fields(F.col(value), ITEM_KEYS)})
    it = J.JsonObject(F.col("_it"), F.col(value))
    body = it.get("body")
    flat = parsed.select(
        *[c for c in items.columns if c != value],
        F.when(it.get("pull_request").isNotNull() | it.has("pull_request"), "pr").otherwise("issue").alias("kind"),
        it.get("number").try_cast("bigint").alias("number"),
        F.coalesce(it.get("title"), F.lit("")).alias("title"),
        body.alias("_body"),
        snippet(body).alias("body_snippet"),
        it.get("html_url").alias("url"),
        label_names(it.get("labels")).alias("labels"),
        J.iso_timestamp(it.get("created_at")).alias("created_at"),
        J.iso_timestamp(it.get("closed_at")).alias("closed_at"),
    )
    is_revert = (F.col("kind") == "pr") & is_revert_title(F.col("title"))
    return flat.withColumns(
        {
            "case_id": case_id(F.col("kind"), F.col("number")),
            "time_to_resolve_hours": hours_between(F.col("created_at"), F.col("closed_at")),
            "is_revert": is_revert,
            "reverts_number": F.when(
                is_revert, reverted_number(F.col("title"), F.col("_body"))
            ),
        }
    ).drop("_body")


def reverts(flat: DataFrame, position: str) -> DataFrame:
    """Per reverted number, the revert that comes last in input order."""
    return (
        flat.where(F.col("reverts_number").isNotNull())
        .groupBy(F.col("reverts_number").alias("_target"))
        .agg(F.max_by("number", position).alias("_by"))
    )


def link_reverts(flat: DataFrame, position: str) -> DataFrame:
    """Mark the pull requests a later revert points at.

    Issues never match; they take distinct negative join keys, so they spread
    over the tasks instead of meeting on one NULL key.
    """
    key = F.when(F.col("kind") == "pr", F.col("number")).otherwise(-F.col("number") - 1)
    linked = flat.withColumn("_target", key).join(reverts(flat, position), "_target", "left")
    return linked.withColumns(
        {"was_reverted": F.col("_by").isNotNull(), "reverted_by": F.col("_by")}
    ).drop("_target", "_by")


def build_cases(items: DataFrame, position: str, value: str = "value") -> DataFrame:
    """Landed items to case rows; `position` is the input order.

    The parsed items are stored first: the rows and the reverts among them both
    read them, and parsing whole texts costs far more than storing their snippets.
    """
    flat = written(flatten_items(items, value), "items")
    return link_reverts(flat, position).select(*_COLUMNS)


def build_totals(cases: DataFrame) -> DataFrame:
    """Size, distinct reverted numbers and linked cases of a build."""
    return cases.agg(
        F.count("*").alias("total"),
        F.countDistinct("reverts_number").alias("reverts"),
        F.count_if("was_reverted").alias("linked"),
    )


def case_count(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("case_count"))


def case_text() -> Column:
    """The text that stands for a case: title and snippet, stripped."""
    return joined_subject(F.col("title"), F.col("body_snippet"))


def hash_embedder(dim: int):
    """Embedder with hash vectors; any other model has the same signature."""

    def embed(rows: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        # As a value: a filter on the vectors, such as exploding them implies, would compute them twice.
        return evaluated_once(rows, {out: hash_vector(F.col(text), dim, "float")})

    return embed


def batch_embedder(fn, batch_rows: int = 128):
    """Embedder around a batch function `list[str] -> list[list[float]]`.

    Runs in Arrow batches on the executors; `fn` must be picklable and load
    its model there.
    """

    def embed(rows: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        @F.pandas_udf("array<float>")
        def vectors(texts: pd.Series) -> pd.Series:
            found = []
            for start in range(0, len(texts), batch_rows):
                found.extend(fn(texts.iloc[start : start + batch_rows].tolist()))
            return pd.Series(found, index=texts.index)

        return rows.withColumn(out, vectors(F.col(text)))

    return embed


def embed_cases(cases: DataFrame, embed) -> DataFrame:
    """One vector per case.

    The short texts are dealt out first: a stored table may come in few tasks,
    and embedding costs far more than moving them.
    """
    texts = cases.select("case_id", case_text().alias("_text")).repartition("case_id")
    return embed(texts, "_text").select("case_id", "embedding")


def searchable(cases: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Cases with their vectors; cases without one are not searchable."""
    return cases.join(embeddings, "case_id")
