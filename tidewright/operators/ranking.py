"""Ranks and shares over small aggregate results, top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHARE_STEPS_PERCENT = 5
MAX_BAR_WIDTH = 14


def ranked(rows: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """1-based rank over an already limited result (a top-n report)."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def share_of_total(rows: DataFrame, count: str) -> DataFrame:
    """Percent of the grand total and its bar length.

    The total is a scalar subquery, so no row travels to a single task.
    """
    total = rows.agg(F.sum(count)).scalar()
    pct = F.col(count) / total * 100
    return rows.withColumns(
        {
            "total": total,
            "pct": pct,
            "bar": F.greatest(F.lit(1), F.floor(pct / SHARE_STEPS_PERCENT).cast("int")),
        }
    )


def share_of_max(rows: DataFrame, count: str) -> DataFrame:
    """Bar length relative to the largest group."""
    largest = rows.agg(F.max(count)).scalar()
    bar = F.bround(F.col(count) / largest * MAX_BAR_WIDTH, 0).cast("int")
    return rows.withColumn("bar", F.greatest(F.lit(1), bar))


def top_k(rows: DataFrame, key: str | list[str], k: int, *order: Column | str, name: str = "rank") -> DataFrame:
    """First k rows of each key with their rank.

    Planned as a group limit before the shuffle: at most k rows per key and
    map task travel, whatever the size of the group.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= k)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Up to n rows picked by a seeded digest of the key; same input, same rows on any engine."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return rows.orderBy(drawn, key).limit(n)
