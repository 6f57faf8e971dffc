"""Parameter limits and time filters shared by all analyses.

No analysis reads the wall clock: the caller passes ``as_of`` (or ``day``), so a
run can be repeated and checked.
"""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameter ranges and defaults.
DEFAULT_LIMIT, MAX_LIMIT = 100, 1000
DEFAULT_HOURS, MAX_HOURS = 24, 24 * 365
DEFAULT_SCORE = 0.85


def _whole(name: str, value: object, low: int, high: int) -> int:
    try:
        number = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} must be a whole number, not {value!r}") from None
    if not low <= number <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, not {number}")
    return number


def row_limit(value: object = None, default: int | None = None) -> int | None:
    """The number of rows asked for; None: all of them."""
    return default if value is None else _whole("limit", value, 1, 2**31 - 1)


def asked_limit(value: object = None) -> int | None:
    """A limit as a question or the command line may state it."""
    return None if value is None else _whole("limit", value, 1, MAX_LIMIT)


def first_rows(df: DataFrame, limit: object = None, default: int | None = None) -> DataFrame:
    """The first rows of an ordered table; all of them where neither the caller nor a default says how many."""
    n = row_limit(limit, default)
    return df if n is None else df.limit(n)


def look_back_hours(value: object = None) -> int:
    return DEFAULT_HOURS if value is None else _whole("hours", value, 1, MAX_HOURS)


def look_back_days(value: object) -> int:
    return _whole("days", value, 0, MAX_HOURS // 24)


def score_threshold(value: object = None) -> float:
    if value is None:
        return DEFAULT_SCORE
    try:
        score = float(value)
    except (TypeError, ValueError):
        raise ValueError(f"score must be a number, not {value!r}") from None
    if math.isnan(score) or not 0.0 <= score <= 1.0:
        raise ValueError(f"score must lie in 0..1, not {score}")
    return score


def in_utc(moment: datetime) -> datetime:
    """``moment`` without a zone, in UTC. Naive values are UTC already."""
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def moment_like(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` as a literal of exactly the column's timestamp type.

    A literal of the other timestamp type would wrap the column in a cast, which
    keeps the comparison out of the Parquet scan. Naive values mean UTC.
    """
    text = in_utc(moment).isoformat(sep=" ", timespec="microseconds")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "Z").cast("timestamp")


def _from(df: DataFrame, lower: datetime, column: str) -> DataFrame:
    """Rows from ``lower`` on.

    Where the table has an ``event_date`` the implied date bound is added, since
    partitions are pruned by that column alone.
    """
    kept = df.filter(F.col(column) >= moment_like(df, column, lower))
    if "event_date" in df.columns:
        kept = kept.filter(F.col("event_date") >= F.lit(in_utc(lower).date()))
    return kept


def since(df: DataFrame, as_of: datetime, hours: object = None, column: str = "timestamp") -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (a lower bound only)."""
    return _from(df, as_of - timedelta(hours=look_back_hours(hours)), column)


def since_minutes(df: DataFrame, as_of: datetime, minutes: int, column: str = "timestamp") -> DataFrame:
    """Like :func:`since` for windows shorter than an hour."""
    return _from(df, as_of - timedelta(minutes=_whole("minutes", minutes, 1, MAX_HOURS * 60)), column)


def since_date(df: DataFrame, day: date, days: object) -> DataFrame:
    """Rows whose partition date is at most ``days`` before ``day``."""
    return df.filter(F.col("event_date") >= F.lit(day - timedelta(days=look_back_days(days))))


def on_day(df: DataFrame, day: date) -> DataFrame:
    return df.filter(F.col("event_date") == F.lit(day))
