"""When jobs start: counts per hour, weekday and day of year, and their distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.columns import ratio
from nodeledger.operators.slices import fan_out, period_keys, slice_keys, tag_period
from nodeledger.plans.dense import densify
from nodeledger.schema import WEEKDAYS


def _weekday_name(index):
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), index + 1)


def _counts(df, period: str, period_of, bin_name: str, bin_of, axis, slices) -> DataFrame:
    """Started jobs per (period, bin): every bin of a period that has any job."""
    start = F.col("start_timestamp")
    binned = tag_period(df.filter(start.isNotNull()), slices).select(
        *period_keys(slices), period_of(start).alias(period), bin_of(start).alias(bin_name)
    )
    counts = binned.groupBy(*period_keys(slices), period, bin_name).agg(F.count("*").alias("n_jobs"))
    groups = slice_keys(slices)
    if slices:
        fanned = fan_out(counts, slices)
        counts = fanned.groupBy(*groups, period, bin_name).agg(F.sum("n_jobs").alias("n_jobs"))
    return densify(counts, [*groups, period], bin_name, "n_jobs", axis, total="n_period")


def hourly_counts(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Jobs per hour of each date that has a job."""
    hours = F.sequence(F.lit(0), F.lit(23))
    return _counts(df, "date", F.to_date, "hour", F.hour, hours, slices)


def weekday_counts(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Jobs per weekday of each ISO week number; years share their week numbers."""
    days = F.sequence(F.lit(0), F.lit(6))
    counts = _counts(df, "iso_week", F.weekofyear, "bin_order", F.weekday, days, slices)
    return counts.withColumn("weekday", _weekday_name(F.col("bin_order")))


def dayofyear_counts(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Jobs per day 1 to 366 of each year that has a job."""
    days = F.sequence(F.lit(1), F.lit(366))
    return _counts(df, "year", F.year, "day_of_year", F.dayofyear, days, slices)


def _distribution(counts: DataFrame, bins: Sequence[str], slices) -> DataFrame:
    """Mean and sample deviation over periods of each bin's percentage of its period."""
    percent = ratio(F.col("n_jobs") * 100, F.col("n_period"))
    return counts.groupBy(*slice_keys(slices), *bins).agg(
        F.avg(percent).alias("mean_percent"), F.stddev_samp(percent).alias("std_percent")
    )


def hour_distribution(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    return _distribution(hourly_counts(df, slices=slices), ["hour"], slices)


def weekday_distribution(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    return _distribution(weekday_counts(df, slices=slices), ["bin_order", "weekday"], slices)


def dayofyear_distribution(
    df: DataFrame, *, slices: Sequence[str] | None = None, window: int = 7
) -> DataFrame:
    """Day-of-year distribution with a centred rolling mean and its band.

    The rolling windows run over the 366 rows of a slice.
    """
    daily = _distribution(dayofyear_counts(df, slices=slices), ["day_of_year"], slices)
    before = window // 2
    near = Window.partitionBy(*slice_keys(slices)).orderBy("day_of_year")
    near = near.rowsBetween(-before, window - 1 - before)
    smooth = daily.withColumns(
        {
            "mean_smooth": F.avg("mean_percent").over(near),
            "std_smooth": F.avg("std_percent").over(near),
        }
    )
    return smooth.withColumns(
        {
            "band_low": F.col("mean_smooth") - F.col("std_smooth"),
            "band_high": F.col("mean_smooth") + F.col("std_smooth"),
        }
    )


def dataset_profile(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Number of queues and the ranges of start time, nodes and walltime."""
    per_queue = tag_period(df, slices).groupBy(*period_keys(slices), "queue_name").agg(
        F.count("*").alias("n_jobs"),
        *[F.min(c).alias(f"min_{c}") for c in _PROFILED],
        *[F.max(c).alias(f"max_{c}") for c in _PROFILED],
    )
    return fan_out(per_queue, slices).groupBy(*slice_keys(slices)).agg(
        F.coalesce(F.sum("n_jobs"), F.lit(0)).alias("n_jobs"),
        F.count_distinct("queue_name").alias("n_queues"),
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in _PROFILED],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in _PROFILED],
    )


_PROFILED = ("start_timestamp", "nodes_used", "walltime_seconds")
