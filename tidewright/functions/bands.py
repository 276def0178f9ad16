"""Qualitative bands. Every threshold here is a fixed value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def descending_band(value: Column, steps: list[tuple[float, str]], low: str) -> Column:
    """First label whose floor the value reaches."""
    band = None
    for floor, label in steps:
        test = value >= F.lit(float(floor))
        band = F.when(test, label) if band is None else band.when(test, label)
    return band.otherwise(low)


def similarity_band(score: Column) -> Column:
    return descending_band(score, [(0.75, "high"), (0.50, "medium")], "low")


def lag_band(avg_seconds: Column) -> Column:
    return (
        F.when(avg_seconds.isNull(), F.lit(None).cast("string"))
        .otherwise(descending_band(avg_seconds, [(60.0, "high"), (30.0, "elevated")], "healthy"))
    )


def failure_severity(rate: Column) -> Column:
    return descending_band(rate, [(0.35, "high"), (0.15, "medium")], "low")


def evidence_strength(sample_size: Column) -> Column:
    return (
        F.when(sample_size == 0, "insufficient")
        .when(sample_size < 3, "weak")
        .otherwise("ok")
    )
