"""Evaluation time, look-back and window predicates.

All bounds are folded to literals, so they reach the Parquet scan as pushed
filters and, on date-partitioned tables, as partition filters.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.schemas import LATE_PARTITION

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def to_micros(when: datetime | int) -> int:
    """Epoch microseconds; a datetime without offset is read as UTC."""
    if isinstance(when, int):
        return when
    if when.tzinfo is None:
        when = when.replace(tzinfo=timezone.utc)
    return (when - _EPOCH) // timedelta(microseconds=1)


def now_micros() -> int:
    return to_micros(datetime.now(tz=timezone.utc))


def latest_micros(df: DataFrame, ts: str) -> int | None:
    """Newest value of a time column as epoch microseconds (one-row action)."""
    row = df.agg(F.max(ts).cast("timestamp").alias("m")).select(
        F.unix_micros("m").alias("us")
    ).first()
    return row["us"] if row else None


def resolve_as_of(df: DataFrame, ts: str, as_of: datetime | int | None) -> int:
    """Given evaluation time, or the newest time in the table."""
    if as_of is not None:
        return to_micros(as_of)
    latest = latest_micros(df, ts)
    return 0 if latest is None else latest


def bound(df: DataFrame, ts: str, micros: int) -> Column:
    """A literal of the same time type as the column it is compared with."""
    literal = F.timestamp_micros(F.lit(micros))
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return literal.cast("timestamp_ntz")
    return literal


def _date_floor(df: DataFrame, micros: int) -> Column | None:
    """Partition predicate for rows at or after an instant.

    The late partition can hold any event time and is always kept.
    """
    if "date" not in df.columns or not isinstance(df.schema["date"].dataType, T.StringType):
        return None
    day = (_EPOCH + timedelta(microseconds=micros)).strftime("%Y-%m-%d")
    return (F.col("date") >= day) | (F.col("date") == LATE_PARTITION)


def lookback(
    df: DataFrame, ts: str, as_of: int, minutes: float, late_hours: float | None = None
) -> DataFrame:
    """Rows at or after `as_of - minutes`, open towards the future.

    `created_at` decides the partition and prunes. `ingested_at` prunes when
    `late_hours`, the threshold the table was written with, is given: a dated
    row was created at most that long before it came in.
    """
    start = as_of - int(minutes * MICROS_PER_MINUTE)
    keep = F.col(ts) >= bound(df, ts, start)
    prune = None
    if ts == "created_at":
        prune = _date_floor(df, start)
    elif ts == "ingested_at" and late_hours is not None:
        prune = _date_floor(df, start - int(late_hours * MICROS_PER_HOUR))
    return df.where(keep if prune is None else keep & prune)


def window(
    df: DataFrame, ts: str, as_of: int, since_hours: float, until_hours: float = 0
) -> DataFrame:
    """Rows in `[as_of - since, as_of - until)`."""
    end = as_of - int(until_hours * MICROS_PER_HOUR)
    return lookback(df, ts, as_of, since_hours * 60).where(F.col(ts) < bound(df, ts, end))


def is_recent(df: DataFrame, ts: str, as_of: int, window_hours: float) -> Column:
    """True in the recent part of a recent + baseline span."""
    return F.col(ts) >= bound(df, ts, as_of - int(window_hours * MICROS_PER_HOUR))


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def hours_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(3.6e9)


def seconds_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(1e6)


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH")
