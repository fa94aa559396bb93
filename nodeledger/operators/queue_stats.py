"""Descriptive statistics of each queue and of the whole log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.columns import ratio
from nodeledger.operators.slices import fan_out, period_keys, slice_keys, tag_period
from nodeledger.plans.quantiles import described
from nodeledger.schema import REPORT_METRICS, require_columns


def _per_owner(df: DataFrame, slices) -> DataFrame:
    """Jobs and core-hours per (queue, user, project): much smaller than the log, and enough for
    every count and distinct count of the report."""
    require_columns(df, "queue_name", "used_core_hours", "username_genid", "project_name_genid")
    owners = tag_period(df, slices).groupBy(
        *period_keys(slices), "queue_name", "username_genid", "project_name_genid"
    )
    sums = owners.agg(F.count("*").alias("n_jobs"), F.sum("used_core_hours").alias("_hours"))
    return fan_out(sums, slices)


def _headline(*, distinct: dict[str, str]) -> list[Column]:
    return [
        F.coalesce(F.sum("n_jobs"), F.lit(0)).alias("n_jobs"),
        F.coalesce(F.sum("_hours"), F.lit(0.0)).alias("core_hours"),
        *[F.count_distinct(c).alias(name) for c, name in distinct.items()],
    ]


_OWNERS = {"username_genid": "unique_users", "project_name_genid": "unique_projects"}


def queue_summary_totals(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Jobs, core-hours, queues, users and projects overall; jobs without a queue count too."""
    counted = _headline(distinct={"queue_name": "n_queues", **_OWNERS})
    totals = _per_owner(df, slices).groupBy(*slice_keys(slices)).agg(*counted)
    return totals.withColumnsRenamed({"n_jobs": "total_jobs", "core_hours": "total_core_hours"})


def queue_summary(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Jobs, core-hours, share of all core-hours, users and projects of each queue.

    The share is 0 when there are no core-hours at all.
    """
    groups = slice_keys(slices)
    per_queue = _per_owner(df, slices).groupBy(*groups, "queue_name").agg(*_headline(distinct=_OWNERS))
    overall = F.sum("core_hours").over(Window.partitionBy(*groups))
    share = F.when(overall > 0, F.col("core_hours") / overall * 100).otherwise(0.0)
    return (
        per_queue.withColumn("share_percent", share)
        .filter(F.col("queue_name").isNotNull())
        .select(
            *groups,
            "queue_name",
            "n_jobs",
            "core_hours",
            "share_percent",
            "unique_users",
            "unique_projects",
        )
    )


_QUANTILES = {"p5": 0.05, "median": 0.5, "p95": 0.95}
_STATISTICS = ("n_values", "mean", "median", "std", "p5", "p95", "min", "max")


def metric_stats(
    df: DataFrame,
    metrics: dict[str, Column],
    *,
    keys: Sequence[str] = ("queue_name",),
    slices: Sequence[str] | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles of each metric, in long form.

    Missing values are left out; a metric without values in a group has no row. Everything follows
    from how often each value occurs, so the log is read once and only these counts, by month, are
    copied to their slices.
    """
    groups = [*slice_keys(slices), *keys]
    named = tag_period(df, slices).select(
        *period_keys(slices),
        *keys,
        *[value.cast("double").alias(metric) for metric, value in metrics.items()],
    )
    for key in keys:
        named = named.filter(F.col(key).isNotNull())

    # a metric is its number until the end: rows of counts are shorter by its name
    pairs = F.array(*[F.struct(F.lit(i).alias("_metric"), F.col(m).alias("value")) for i, m in enumerate(metrics, start=1)])
    values = named.select(*period_keys(slices), *keys, F.inline(pairs)).filter(F.col("value").isNotNull())
    counts = values.groupBy(*period_keys(slices), *keys, "_metric", "value").agg(F.count("*").alias("n"))
    spread = (lambda by_period: fan_out(by_period, slices)) if slices else None
    stats = described(counts, [*groups, "_metric"], "value", "n", _QUANTILES, spread, [*keys, "_metric"])
    metric = F.element_at(F.array(*[F.lit(m) for m in metrics]), F.col("_metric")).alias("metric")
    return stats.select(*groups, metric, *_STATISTICS)


def efficiency_metric() -> dict[str, Column]:
    return {"efficiency": ratio(F.col("runtime_seconds"), F.col("walltime_seconds"))}


def report_metrics(df: DataFrame) -> dict[str, Column]:
    """The metrics of the report that ``df`` has."""
    return {m: F.col(m) for m in REPORT_METRICS if m in df.columns}


def queue_metric_stats(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """The report's metrics for each queue."""
    return metric_stats(df, report_metrics(df), slices=slices)


def queue_efficiency(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Runtime as a part of the requested walltime for each queue."""
    stats = metric_stats(df, efficiency_metric(), slices=slices)
    return stats.select(
        *slice_keys(slices),
        "queue_name",
        F.col("n_values").alias("n_jobs"),
        F.col("mean").alias("mean_efficiency"),
        F.col("median").alias("median_efficiency"),
        F.col("std").alias("std_efficiency"),
    )
