"""Exact order statistics per key without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 128


def order_statistics(
    rows: DataFrame, keys: list[str], value: str, ranks: dict[str, Column], buckets: int = BUCKETS
) -> DataFrame:
    """Exact n-th smallest values per key.

    `ranks` maps an output name to a 0-based rank as an expression over `n`,
    the row count of the key. Values are first counted per distinct value.
    Approximate quantiles of the distinct values cut each key into buckets of
    about equal size, bucket counts locate the wanted rank exactly, and only
    the bucket that holds it is ordered: no task sees more than about
    1/`buckets` of the distinct values of a key. Rows without a value are left
    out.
    """
    counted = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_c"))
    )
    cuts = [i / buckets for i in range(1, buckets)]
    spans = counted.groupBy(*keys).agg(
        F.percentile_approx("_v", cuts, 1000).alias("_cuts"), F.sum("_c").alias("n")
    )
    bucket = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    placed = counted.join(spans, keys).withColumn("_b", bucket).drop("_cuts")
    by_key = Window.partitionBy(*keys)
    # At most `buckets` rows per key.
    histogram = (
        placed.groupBy(*keys, "_b")
        .agg(F.sum("_c").alias("_bc"), F.first("n").alias("n"))
        .withColumn("_end", F.sum("_bc").over(by_key.orderBy("_b")))
        .withColumn("_start", F.col("_end") - F.col("_bc"))
    )
    wanted = histogram.select(
        *keys,
        "_b",
        "_start",
        "_end",
        "n",
        F.explode(
            F.create_map(
                *[c for name, rank in ranks.items() for c in (F.lit(name), rank.cast("bigint"))]
            )
        ).alias("_name", "_rank"),
    ).where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))
    # One row per key and statistic, so the join cannot fan out.
    in_bucket = placed.drop("n").join(wanted, [*keys, "_b"])
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_name").orderBy("_v"))
    hit = (
        in_bucket.withColumn("_upto", F.col("_start") + upto)
        .where(F.col("_upto") > F.col("_rank"))
        .groupBy(*keys, "n", "_name")
        .agg(F.min("_v").alias("_value"))
    )
    return hit.groupBy(*keys, "n").agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in ranks]
    )


def median_and_tail(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median (mean of the two middle values) and the tail value.

    The tail is the sorted value at index `max(0, int(0.99 n) - 1)`.
    """
    n = F.col("n")
    stats = order_statistics(
        rows,
        keys,
        value,
        {
            "_mid_low": F.floor((n - 1) / F.lit(2)),
            "_mid_high": F.floor(n / F.lit(2)),
            "p99": F.greatest(F.lit(0), F.floor(n * F.lit(0.99)) - 1),
        },
    )
    return stats.select(
        *keys, "n", ((F.col("_mid_low") + F.col("_mid_high")) / 2).alias("p50"), "p99"
    )
