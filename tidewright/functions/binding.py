"""Evaluating an expression once, inside another one or per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it inside `body`.

    An outer expression placed inside a lambda is evaluated again for every
    element; a lambda variable is not.
    """
    return F.transform(F.array(value), body).getItem(0)


def evaluated_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever uses them later.

    The optimizer copies the expression of an ordinary column into every
    filter and column above it, which multiplies a costly parse. A generator
    of one element keeps its output as a value.
    """
    item = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in rows.columns if c not in columns]
    return rows.select("*", F.explode(F.array(item)).alias("_once")).select(
        *kept, *[F.col(f"_once.{name}").alias(name) for name in columns]
    )
