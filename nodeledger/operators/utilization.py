"""Nodes in use over time, their statistics, the regular grid and its rolling mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.columns import ratio
from nodeledger.functions.times import bucket_start, epoch_micros, seconds_between
from nodeledger.operators.slices import fan_out, period_keys, slice_keys, tag_period, with_slices
from nodeledger.plans.attach import attach
from nodeledger.plans.ordered_scan import BUCKET, ordered_scan
from nodeledger.schema import GRID_MINUTES, require_columns

_SECONDS_PER_DAY = 86_400


def valid_intervals(df: DataFrame) -> DataFrame:
    """Jobs that end after they start."""
    require_columns(df, "start_timestamp", "end_timestamp", "nodes_used")
    return df.filter(F.col("end_timestamp") > F.col("start_timestamp"))


def utilization_events(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Two events per job: nodes taken at its start, nodes freed at its end."""
    taken, freed = F.col("nodes_used"), -F.col("nodes_used")
    changes = F.array(
        F.struct(F.col("start_timestamp").alias("t"), taken.alias("delta")),
        F.struct(F.col("end_timestamp").alias("t"), freed.alias("delta")),
    )
    return valid_intervals(df).select(*keep, F.inline(changes))


def nodes_in_use(
    df: DataFrame, *, slices: Sequence[str] | None = None, keep_bucket: bool = False
) -> DataFrame:
    """Nodes in use from each instant with an event until the next one.

    A slice holds the jobs that start in it, so its count begins at 0 and may run past its end.
    Only net changes by month are shuffled; they are copied to their slices in the tasks that scan
    them. ``keep_bucket`` keeps the column by which these tasks hold the rows.
    """
    events = utilization_events(tag_period(df, slices), keep=period_keys(slices))
    net = events.groupBy(*period_keys(slices), "t").agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("delta"))
    nodes = ordered_scan(
        net,
        "t",
        {"nodes_in_use": "delta"},
        slice_keys(slices),
        following="next_t",
        number="event_no",
        spread=(lambda changes: fan_out(changes, slices)) if slices else None,
        keep_bucket=keep_bucket,
    )
    kept = [*slice_keys(slices), "t", "delta", "nodes_in_use", "event_no", "next_t"]
    return nodes.select(*kept, *([BUCKET] if keep_bucket else []))


def effective_capacity(
    df: DataFrame, capacity: int, *, slices: Sequence[str] | None = None
) -> DataFrame | None:
    """The capacity to use when none is configured: the largest job, or ``None`` if not needed."""
    if capacity > 0:
        return None
    return with_slices(df, slices).groupBy(*slice_keys(slices)).agg(
        F.max("nodes_used").alias("capacity")
    )


def with_capacity(
    nodes: DataFrame, capacity: int, fallback: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    if fallback is None:
        return nodes.withColumn("capacity", F.lit(int(capacity)).cast("bigint"))
    return attach(nodes, fallback, keys)


def _percent_of(nodes: Column) -> Column:
    return ratio(nodes, F.col("capacity")) * 100


def utilization_stats(
    nodes: DataFrame,
    capacity: int,
    *,
    fallback: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Minimum, maximum and time-weighted mean and deviation of the nodes in use."""
    weight = seconds_between("t", "next_t")
    level = F.col("nodes_in_use").cast("double")
    sums = nodes.groupBy(*keys).agg(
        F.min("nodes_in_use").alias("min_nodes"),
        F.max("nodes_in_use").alias("max_nodes"),
        F.sum(weight).alias("_time"),
        F.sum(level * weight).alias("_first"),
        F.sum(level * level * weight).alias("_second"),
    )
    mean = ratio(F.col("_first"), F.col("_time"))
    spread = ratio(F.col("_second"), F.col("_time")) - mean * mean
    stats = with_capacity(sums, capacity, fallback, keys).select(
        *keys,
        "capacity",
        "min_nodes",
        "max_nodes",
        mean.alias("mean_nodes"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std_nodes"),
    )
    return stats.withColumns(
        {f"{s}_percent": _percent_of(F.col(f"{s}_nodes")) for s in ("min", "max", "mean", "std")}
    )


def utilization_grid(
    nodes: DataFrame,
    capacity: int,
    *,
    fallback: DataFrame | None = None,
    keys: Sequence[str] = (),
    minutes: int = GRID_MINUTES,
) -> DataFrame:
    """Nodes in use at every grid point from just before the first to just before the last event.

    Each instant writes the grid points up to the next instant, so no ordering is needed. A gap is
    cut into days first and then into the points of each, so no row holds the points of a long gap.
    Before the first instant the level is 0.
    """
    step = minutes * 60
    per_day = max(1, _SECONDS_PER_DAY // step)
    micros = F.lit(step * 1_000_000)
    here, following = epoch_micros("t") / micros, epoch_micros("next_t") / micros
    first = F.when(F.col("event_no") == 1, F.floor(here)).otherwise(F.ceil(here))
    last = F.coalesce(F.ceil(following) - 1, F.floor(here))
    from_day = F.greatest("_first", F.col("_day") * per_day)
    to_day = F.least("_last", F.col("_day") * per_day + (per_day - 1))
    points = (
        nodes.withColumns({"_first": first, "_last": last})
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("_day", F.explode(F.sequence(F.floor(F.col("_first") / per_day), F.floor(F.col("_last") / per_day))))
        .select(*keys, "t", "nodes_in_use", F.explode(F.sequence(from_day, to_day)).alias("grid_index"))
        .withColumn("grid_time", bucket_start(F.col("grid_index"), step))
    )
    level = F.when(F.col("grid_time") < F.col("t"), F.lit(0)).otherwise(F.col("nodes_in_use"))
    placed = points.select(*keys, "grid_index", "grid_time", level.alias("nodes_in_use"))
    return with_capacity(placed, capacity, fallback, keys).select(
        *keys,
        "grid_index",
        "grid_time",
        "nodes_in_use",
        _percent_of(F.col("nodes_in_use")).alias("utilization_percent"),
    )


def with_reference_lines(
    grid: DataFrame, stats: DataFrame, *, keys: Sequence[str] = ()
) -> DataFrame:
    """Add the mean line, its band and the half-capacity line to a grid."""
    lines = stats.select(*keys, "mean_percent", "std_percent")
    return attach(grid, lines, keys).select(
        *grid.columns,
        "mean_percent",
        (F.col("mean_percent") - F.col("std_percent")).alias("band_low"),
        (F.col("mean_percent") + F.col("std_percent")).alias("band_high"),
        F.lit(50.0).alias("half_capacity"),
    )


def utilization_rolling(
    grid: DataFrame, *, keys: Sequence[str] = (), minutes: int = GRID_MINUTES
) -> DataFrame:
    """Mean utilization of the day that ends at each grid point.

    A point is copied to its own day and the next, and each pair of days is averaged on its own: a
    day's sum is the running sum less the running sum one day before. ``minutes`` divides a day.
    """
    if _SECONDS_PER_DAY % (minutes * 60):
        raise ValueError(f"a day has no whole number of steps of {minutes} minutes")
    per_day = _SECONDS_PER_DAY // (minutes * 60)
    own = F.floor(F.col("grid_index") / per_day)
    copies = grid.withColumn("_own", own).withColumn(
        "_day", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    two_days = Window.partitionBy(*keys, "_day").orderBy("grid_index")
    so_far = two_days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = copies.withColumns(
        {
            "_sum": F.sum("utilization_percent").over(so_far),
            "_points": F.least(F.row_number().over(two_days), F.lit(per_day)),
        }
    )
    before = F.coalesce(F.lag("_sum", per_day).over(two_days), F.lit(0.0))
    averaged = summed.withColumn("rolling_percent", (F.col("_sum") - before) / F.col("_points"))
    return averaged.filter("_own = _day").select(*grid.columns, "rolling_percent")
