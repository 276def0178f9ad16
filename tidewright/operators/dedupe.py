"""Duplicate removal inside a batch and against stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewright.functions.time_bounds import date_key
from tidewright.schemas import LATE_PARTITION

# More days than this are bounded by the first and the last one.
MAX_LISTED_DAYS = 400


def first_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Keep the first row of each key in the given order.

    The rank filter is planned as a group limit before the shuffle, so a key
    that fills a whole partition leaves it as one row.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def known_ids(new: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys of `new` that are stored already.

    The stored side stays where it is: it meets the batch's few keys, which a
    semi join can broadcast, and only the repeated ones go on.
    """
    return stored.select(key).join(new.select(key), key, "left_semi").distinct()


def not_stored(new: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key is not stored yet."""
    return new.join(known_ids(new, stored, key), key, "left_anti")


def batch_span() -> list:
    """Aggregates over a batch that tell where its ids can be stored.

    Expects `created_at`, `created_at_ok` and `date`.
    """
    is_late = F.col("date") == LATE_PARTITION
    return [
        F.coalesce(F.bool_or(~F.col("created_at_ok")), F.lit(False)).alias("undated"),
        F.unix_micros(F.min(F.when(is_late, F.col("created_at")))).alias("low"),
        F.unix_micros(F.max(F.when(is_late, F.col("created_at")))).alias("high"),
        # Calendar days: few, whatever the size of the batch.
        F.collect_set(date_key(F.col("created_at"))).alias("days"),
    ]


def undated_days(batch: DataFrame, index: DataFrame) -> list[str]:
    """Days under which undated events of this batch may be stored.

    `index` has the id and the day of every undated event ever stored.
    """
    asked = batch.where(~F.col("created_at_ok")).select("event_id")
    rows = index.join(asked, "event_id", "left_semi")
    return rows.agg(F.collect_set("day")).first()[0]


def stored_candidates(stored: DataFrame, span, more_days: list[str] = ()) -> DataFrame:
    """The part of the event table that may hold ids of a batch.

    An event lands under its event day, or under `late` once it is old enough.
    A batch therefore needs its event days, plus the late rows whose event time
    lies in its late range. An event without a usable time was filed under the
    day it came in; `more_days` names those. `span` is a row of `batch_span`.
    """
    days = sorted({*span["days"], *more_days})
    day = F.col("date")
    if len(days) > MAX_LISTED_DAYS:
        keep = (day != LATE_PARTITION) & day.between(days[0], days[-1])
    else:
        keep = day.isin(days)
    if span["low"] is not None:
        keep = keep | (
            (day == LATE_PARTITION)
            & F.col("created_at").between(
                F.timestamp_micros(F.lit(span["low"])), F.timestamp_micros(F.lit(span["high"]))
            )
        )
    return stored.where(keep)
