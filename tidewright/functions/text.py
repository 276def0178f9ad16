"""Text rules for cases, reverts, messages and number formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns that define reverts and version tags.
REVERT_TITLE = r"(?i)^revert\b"
REVERTS_IN_BODY = r"(?i)reverts\s+[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+#([0-9]+)"
NUMBER_REFERENCE = r"#([0-9]+)"
VERSION_TAG = r"(?i)^v?[0-9]+\.[0-9]+(\.[0-9]+)?"

# Cut lengths and case-text separator.
SNIPPET_CHARS = 1000
TRIMMED_SNIPPET_CHARS = 200


def strip_whitespace(text: Column) -> Column:
    """Strip every kind of white space; `trim` takes spaces only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def is_revert_title(title: Column) -> Column:
    return title.rlike(REVERT_TITLE)


def reverted_number(title: Column, body: Column) -> Column:
    """Number named in the body, else the first `#N` of the title."""
    return F.coalesce(
        first_group(body, REVERTS_IN_BODY), first_group(title, NUMBER_REFERENCE)
    ).try_cast("bigint")


def snippet(text: Column, length: int = SNIPPET_CHARS) -> Column:
    return F.nullif(F.substring(text, 1, length), F.lit(""))


def joined_subject(title: Column, rest: Column) -> Column:
    return strip_whitespace(F.concat(title, F.lit("\n"), F.coalesce(rest, F.lit(""))))


def quoted(text: Column) -> Column:
    """Single-quoted, or double-quoted when the text holds a single quote."""
    has_single = F.contains(text, F.lit("'"))
    has_double = F.contains(text, F.lit('"'))
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(
            F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
        )
    )


def percent(value: Column) -> Column:
    """Whole percent, ties to even."""
    return F.format_string("%.0f%%", F.bround(value * 100, 0))


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", F.bround(value.cast("double"), 1))


def listed(items: Column, default: str = "none") -> Column:
    """Comma-joined list, or the default for a null or empty one."""
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit(default))
