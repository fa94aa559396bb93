"""Full-range, per-year and per-month results from one job.

A sliced operator first aggregates by the period tag, which is one extra grouping column, and fans
the small aggregate out to its slices. The fact table itself is neither copied nor scanned once
per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.functions.times import calendar_bucket

ALL, YEAR, MONTH = "all", "year", "month"
EVERY_LEVEL = (ALL, YEAR, MONTH)
PERIOD = "_period"
SLICE = "slice"


def _check(levels: Sequence[str] | None) -> None:
    unknown = set(levels or ()) - set(EVERY_LEVEL)
    if unknown:
        raise ValueError(f"unknown slice levels {sorted(unknown)}")


def period_keys(levels: Sequence[str] | None) -> list[str]:
    """Grouping columns of the first, not yet sliced aggregation."""
    return [PERIOD] if levels else []


def slice_keys(levels: Sequence[str] | None) -> list[str]:
    """Grouping columns after :func:`fan_out`."""
    return [SLICE] if levels else []


def tag_period(df: DataFrame, levels: Sequence[str] | None) -> DataFrame:
    """Add the start month of each job (null for a job without a start)."""
    _check(levels)
    if not levels:
        return df
    return df.withColumn(PERIOD, calendar_bucket("start_timestamp", "monthly"))


def fan_out(df: DataFrame, levels: Sequence[str] | None) -> DataFrame:
    """Replace the period tag by one row per slice the period belongs to."""
    if not levels:
        return df
    text = F.col(PERIOD).cast("string")
    labels = {ALL: F.lit("all"), YEAR: F.substring(text, 1, 4), MONTH: F.substring(text, 1, 7)}
    wanted = F.array(*[labels[level] for level in EVERY_LEVEL if level in levels])
    fanned = df.withColumn(SLICE, F.explode(wanted)).drop(PERIOD)
    return fanned.filter(F.col(SLICE).isNotNull())


def with_slices(df: DataFrame, levels: Sequence[str] | None) -> DataFrame:
    """Fan out without a preceding aggregation, for results that cannot be added up."""
    return fan_out(tag_period(df, levels), levels)


def slice_counts(df: DataFrame, levels: Sequence[str] = EVERY_LEVEL) -> DataFrame:
    """Jobs per slice: the years and (year, month) pairs present, with their sizes."""
    tagged = tag_period(df, levels).groupBy(*period_keys(levels)).agg(F.count("*").alias("n_jobs"))
    return fan_out(tagged, levels).groupBy(SLICE).agg(F.sum("n_jobs").alias("n_jobs"))


def slices_present(df: DataFrame) -> DataFrame:
    """Distinct (year, month) pairs of the start time."""
    start = F.col("start_timestamp")
    pairs = df.filter(start.isNotNull()).select(
        F.year(start).alias("year"), F.month(start).alias("month")
    )
    return pairs.distinct()


def in_period(df: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """Jobs that started in one year, or in one month of it.

    The period is a range of the start time, which a scan can use, and names the folders of a log
    that is partitioned by start year and month.
    """
    after = (year + 1, 1) if month is None or month == 12 else (year, month + 1)
    first, end = (F.lit(f"{y:04d}-{m:02d}-01").cast("timestamp_ntz") for y, m in ((year, month or 1), after))
    start = F.col("start_timestamp")
    kept = df.filter((start >= first) & (start < end))
    for name, value in (("start_year", year), ("start_month", month)):
        if name in df.columns and value is not None:
            kept = kept.filter(F.col(name) == value)
    return kept
