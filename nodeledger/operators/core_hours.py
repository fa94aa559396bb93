"""Core-hours of each queue over days, weeks and months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.columns import ratio
from nodeledger.functions.times import calendar_bucket, seconds_between
from nodeledger.operators.slices import (
    ALL,
    MONTH,
    SLICE,
    YEAR,
    fan_out,
    period_keys,
    slice_keys,
    tag_period,
)
from nodeledger.plans.attach import attach
from nodeledger.plans.dense import densify
from nodeledger.plans.settle import settle
from nodeledger.schema import AREA_SHARE_PERCENT, PIE_SHARE_PERCENT, TOP_QUEUES, require_columns

OTHER = "Other"
_NEEDED = ("start_timestamp", "queue_name", "used_core_hours")
SCOPE_KEYS = ("scope", "granularity", "period")
_DAYS_BEFORE_WEEKLY, _DAYS_BEFORE_MONTHLY = 30, 365


def _located(df: DataFrame) -> DataFrame:
    """Jobs that have a start and a queue, which is all that can be placed in a table."""
    require_columns(df, *_NEEDED)
    return df.filter(F.col("start_timestamp").isNotNull() & F.col("queue_name").isNotNull())


def _hours(column: str = "used_core_hours") -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0)).alias("core_hours")


def core_hours(
    df: DataFrame, granularity: str, *, slices: Sequence[str] | None = None
) -> DataFrame:
    """Core-hours per bucket and queue, 0 where a queue is idle in a bucket, with the row total.

    ``granularity`` is daily, weekly (from Monday) or monthly. A slice only has its own buckets
    and queues; a week that straddles two slices is in both, with each slice's jobs.
    """
    located = tag_period(_located(df), slices)
    located = located.withColumn("bucket", calendar_bucket("start_timestamp", granularity))
    tags = [c for c in located.columns if c not in df.columns]
    sums = located.groupBy(*tags, "queue_name").agg(_hours())
    groups = [SLICE] if slices else []
    if slices:
        sums = fan_out(sums, slices).groupBy(*groups, "bucket", "queue_name").agg(_hours("core_hours"))
    return densify(
        sums,
        [*groups, "bucket"],
        "queue_name",
        "core_hours",
        within=groups,
        total="total_core_hours",
    )


def daily_core_hours(df: DataFrame, **options) -> DataFrame:
    return core_hours(df, "daily", **options)


def weekly_core_hours(df: DataFrame, **options) -> DataFrame:
    return core_hours(df, "weekly", **options)


def monthly_core_hours(df: DataFrame, **options) -> DataFrame:
    return core_hours(df, "monthly", **options)


def core_hours_wide(
    table: DataFrame, queues: Sequence[str] | None = None, *, groups: Sequence[str] = ()
) -> DataFrame:
    """A column per queue and ``total_runtime_hours``. Naming the queues saves finding them."""
    pivoted = (
        table.groupBy(*groups, "bucket", F.col("total_core_hours").alias("total_runtime_hours"))
        .pivot("queue_name", list(queues) if queues else None)
        .agg(F.first("core_hours"))
    )
    fixed = (*groups, "bucket", "total_runtime_hours")
    names = [c for c in pivoted.columns if c not in fixed]
    return pivoted.select(
        *groups,
        "bucket",
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in names],
        "total_runtime_hours",
    )


def _queue_totals(table: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Total, share and rank (ties by name) of each queue."""
    totals = table.groupBy(*groups, "queue_name").agg(F.sum("core_hours").alias("_hours"))
    largest = Window.partitionBy(*groups).orderBy(F.desc("_hours"), "queue_name")
    overall = F.sum("_hours").over(Window.partitionBy(*groups))
    return totals.withColumns({"_rank": F.row_number().over(largest), "_overall": overall}).withColumn(
        "_percent", ratio(F.col("_hours") * 100, F.col("_overall"))
    )


def _relabel(table: DataFrame, shown: Column, groups: Sequence[str]) -> DataFrame:
    """Merge the queues that are not ``shown`` into one."""
    labels = _queue_totals(table, groups).select(
        *groups, "queue_name", F.when(shown, F.col("queue_name")).otherwise(OTHER).alias("queue_label")
    )
    return (
        table.join(labels, [*groups, "queue_name"])
        .groupBy(*groups, "bucket", "queue_label")
        .agg(F.sum("core_hours").alias("core_hours"))
    )


def core_hours_top_queues(
    table: DataFrame, top: int = TOP_QUEUES, *, groups: Sequence[str] = ()
) -> DataFrame:
    """The largest queues by total core-hours, the rest as one."""
    return _relabel(table, F.col("_rank") <= top, groups)


def core_hours_cumulative(
    table: DataFrame,
    top: int = TOP_QUEUES,
    share_percent: float = AREA_SHARE_PERCENT,
    *,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Running core-hours of the largest queues and of those with at least ``share_percent``."""
    shown = (F.col("_rank") <= top) | (F.col("_percent") >= share_percent)
    so_far = Window.partitionBy(*groups, "queue_label").orderBy("bucket")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = _relabel(table, shown, groups)
    return merged.withColumn("cumulative_core_hours", F.sum("core_hours").over(so_far))


def core_hours_share(
    table: DataFrame, threshold_percent: float = PIE_SHARE_PERCENT, *, groups: Sequence[str] = ()
) -> DataFrame:
    """Overall share of each queue; queues below the threshold are merged.

    The merged row is left out when it would be empty. Nothing is merged if there are no
    core-hours at all.
    """
    totals = _queue_totals(table, groups)
    kept = (F.col("_overall") == 0) | (F.col("_percent") >= threshold_percent)
    merged = (
        totals.withColumn("_kept", kept)
        .withColumn("queue_label", F.when(kept, F.col("queue_name")).otherwise(OTHER))
        .groupBy(*groups, "queue_label", "_overall")
        .agg(F.sum("_hours").alias("core_hours"), F.bool_or("_kept").alias("_kept"))
        .filter(F.col("_kept") | (F.col("core_hours") > 0))
    )
    percent = ratio(F.col("core_hours") * 100, F.col("_overall")).alias("share_percent")
    return merged.select(*groups, "queue_label", "core_hours", percent)


def _daily_extent(df: DataFrame, slices: Sequence[str] | None) -> DataFrame:
    """Daily sums of each queue with their first and last start; jobs without a queue among them.

    A small table, written once: the tables, which have no nameless queue, and the extent, which
    counts all jobs, are both rolled up from it.
    """
    require_columns(df, *_NEEDED)
    start = F.col("start_timestamp")
    day = calendar_bucket("start_timestamp", "daily").alias("_day")
    started = tag_period(df.filter(start.isNotNull()), slices)
    daily = started.groupBy(*period_keys(slices), day, "queue_name").agg(
        _hours(), F.min(start).alias("_first"), F.max(start).alias("_last")
    )
    return settle(daily)


def _scope(daily: DataFrame, slices: Sequence[str] | None) -> DataFrame:
    """Per slice: the number of years and months with jobs and the granularity of its full range.

    The span is counted in whole days. A month means the month of any year.
    """
    groups = slice_keys(slices)
    months = daily.groupBy(*period_keys(slices), F.year("_day").alias("_year"), F.month("_day").alias("_month")).agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )
    ends = fan_out(months, slices).groupBy(*groups).agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.count_distinct("_year").alias("_years"),
        F.count_distinct("_month").alias("_months"),
    )
    days = F.floor(seconds_between("_first", "_last") / 86_400)
    by_span = (
        F.when(days < _DAYS_BEFORE_WEEKLY, F.lit("daily"))
        .when(days < _DAYS_BEFORE_MONTHLY, F.lit("weekly"))
        .otherwise(F.lit("monthly"))
    )
    return ends.select(*groups, by_span.alias("_by_span"), "_years", "_months")


def _with_scope(df: DataFrame, slices: Sequence[str] | None = None) -> DataFrame:
    """Daily sums with the extent of their slice, which follows from the sums themselves."""
    daily = _daily_extent(df, slices)
    named = fan_out(daily.filter(F.col("queue_name").isNotNull()).drop("_first", "_last"), slices)
    sized = attach(named, _scope(daily, slices), slice_keys(slices))
    return sized.withColumns(
        {
            "_by_span": F.coalesce("_by_span", F.lit("monthly")),
            "_years": F.coalesce("_years", F.lit(0)),
            "_months": F.coalesce("_months", F.lit(0)),
        }
    )


def _chosen_bucket(granularity: Column) -> Column:
    by = {g: calendar_bucket("_day", g) for g in ("daily", "weekly", "monthly")}
    return (
        F.when(granularity == "daily", by["daily"])
        .when(granularity == "weekly", by["weekly"])
        .otherwise(by["monthly"])
    )


def core_hours_auto(df: DataFrame) -> DataFrame:
    """Core-hours over the full range, daily below 30 days, weekly below 365, else monthly."""
    sums = (
        _with_scope(df)
        .withColumn("granularity", F.col("_by_span"))
        .groupBy("granularity", _chosen_bucket(F.col("_by_span")).alias("bucket"), "queue_name")
        .agg(_hours("core_hours"))
    )
    rows = ["granularity", "bucket"]
    return densify(sums, rows, "queue_name", "core_hours", within=rows[:1], total="total_core_hours")


def core_hours_scope(df: DataFrame, *, slices: Sequence[str] | None = None) -> DataFrame:
    """Core-hours at the detail that the extent of the log, or of each slice, calls for.

    More than one year: the full range as :func:`core_hours_auto`. One year and more than one
    month: each year by week. One month: each month by day. ``period`` names the part of the
    range that a table is for.
    """
    day = F.col("_day").cast("string")
    many_years, many_months = F.col("_years") > 1, F.col("_months") > 1
    scope = F.when(many_years, F.lit(ALL)).when(many_months, F.lit(YEAR)).otherwise(F.lit(MONTH))
    detail = F.when(many_years, F.col("_by_span")).when(many_months, F.lit("weekly")).otherwise(F.lit("daily"))
    period = (
        F.when(many_years, F.lit("all"))
        .when(many_months, F.substring(day, 1, 4))
        .otherwise(F.substring(day, 1, 7))
    )
    period = F.coalesce(period, F.lit(""))
    groups = [*slice_keys(slices), *SCOPE_KEYS]
    sums = (
        _with_scope(df, slices)
        .withColumns({"scope": scope, "granularity": detail, "period": period})
        .groupBy(*groups, _chosen_bucket(detail).alias("bucket"), "queue_name")
        .agg(_hours("core_hours"))
    )
    return densify(
        sums, [*groups, "bucket"], "queue_name", "core_hours", within=groups, total="total_core_hours"
    )


def weekly_core_hours_by_year(df: DataFrame) -> DataFrame:
    """The yearly drill-down: each year by week."""
    return weekly_core_hours(df, slices=(YEAR,))


def daily_core_hours_by_month(df: DataFrame) -> DataFrame:
    """The monthly drill-down: each month by day."""
    return daily_core_hours(df, slices=(MONTH,))


def core_hours_charts(table: DataFrame, *, groups: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Inputs of the bar, area and pie charts of one core-hours table."""
    return {
        "bar": core_hours_top_queues(table, groups=groups),
        "area": core_hours_cumulative(table, groups=groups),
        "pie": core_hours_share(table, groups=groups),
    }
