"""Look-up joins whose fact side may be dominated by a few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key with more than this share of the fact rows is hot; at most
# 1 / HOT_SHARE keys can be.
HOT_SHARE = 0.001


def skew_safe_lookup(
    facts: DataFrame, dimension: DataFrame, key: str, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Inner join with a table that has one row per key.

    Rows of hot keys stay where they are and meet a broadcast of their few
    dimension rows, whose number the share bounds; the rest is joined by
    shuffling. `facts` is read three times and should be a stored table.
    """
    counts = facts.groupBy(key).agg(F.count("*").alias("_n"))
    total = facts.agg(F.count("*")).scalar()
    # Below 1 / share rows no key counts as hot, so small inputs stay simple.
    floor = F.greatest(total * F.lit(hot_share), F.lit(1.0 / hot_share))
    hot = counts.where(F.col("_n") > floor).select(key)
    hot_rows = dimension.join(F.broadcast(hot), key, "left_semi")
    return (
        facts.join(F.broadcast(hot_rows), key)
        .unionByName(facts.join(F.broadcast(hot), key, "left_anti").join(dimension, key))
    )
