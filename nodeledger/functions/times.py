"""Time expressions on ``timestamp_ntz`` that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def seconds_between(start, end) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1e6)


def epoch_micros(t) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), F.col(t))


def time_bucket(t, seconds: int) -> Column:
    """Number of the ``seconds``-long bucket that holds ``t``; never decreases with ``t``."""
    return F.floor(epoch_micros(t) / F.lit(seconds * 1_000_000))


def bucket_start(bucket: Column, seconds: int) -> Column:
    """Start time of a bucket numbered by :func:`time_bucket`."""
    return _epoch() + F.expr("INTERVAL '1' SECOND") * (bucket * F.lit(seconds))


def calendar_bucket(t, granularity: str) -> Column:
    """First day of the day, Monday-based week or month that holds ``t``."""
    day = F.to_date(F.col(t))
    if granularity == "daily":
        return day
    if granularity == "weekly":
        return F.trunc(day, "WEEK").cast("date")
    if granularity == "monthly":
        return F.trunc(day, "MM")
    raise ValueError(f"unknown granularity {granularity!r}")
