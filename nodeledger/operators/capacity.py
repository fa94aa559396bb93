"""Intervals in which more nodes are in use than the machine has, and the jobs behind them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.columns import ratio
from nodeledger.functions.times import seconds_between
from nodeledger.operators.slices import slice_keys, with_slices
from nodeledger.operators.utilization import valid_intervals, with_capacity
from nodeledger.plans.ordered_scan import BUCKET, dealt_by_time, ordered_scan
from nodeledger.plans.settle import settle
from nodeledger.plans.stabbing import LEVEL, NODE, moments_in_spans, packed_moments, with_nodes
from nodeledger.schema import MIN_OVER_CAPACITY_SECONDS


def over_capacity_intervals(
    nodes: DataFrame,
    capacity: int,
    *,
    fallback: DataFrame | None = None,
    keys: Sequence[str] = (),
    min_seconds: float = MIN_OVER_CAPACITY_SECONDS,
) -> DataFrame:
    """Intervals above capacity, from the instant of entry to the instant of return.

    The mean is over the instants of the interval, the closing one included, without weights.
    Intervals shorter than ``min_seconds`` are left out before numbering. Rows of ``nodes`` that are
    dealt by a kept bucket are scanned where they are, once; their pieces are written, as every
    bucket adds one at least and several steps read them.
    """
    rated = with_capacity(nodes, capacity, fallback, keys)
    over = F.col("nodes_in_use") > F.col("capacity")
    was_over = F.col("nodes_in_use") - F.col("delta") > F.col("capacity")
    inside = rated.filter(over | was_over).withColumn("_entry", (over & ~was_over).cast("bigint"))
    # a piece of an interval is what one bucket holds of it; the first may continue an earlier bucket
    so_far = Window.partitionBy(BUCKET, *keys).orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = (
        dealt_by_time(inside, "t")
        .withColumn("_piece", F.sum("_entry").over(so_far))
        .groupBy(BUCKET, *keys, "_piece")
        .agg(
            F.min("t").alias("_from"),
            F.max("t").alias("_to"),
            F.max("nodes_in_use").alias("_max"),
            F.sum(F.col("nodes_in_use").cast("double")).alias("_sum"),
            F.count("nodes_in_use").alias("_n"),
        )
        .withColumn("_entry", (F.col("_piece") > 0).cast("bigint"))
        .drop(BUCKET, "_piece")
    )
    found = (
        ordered_scan(settle(pieces), "_from", {"_interval": "_entry"}, keys)
        .groupBy(*keys, "_interval")
        .agg(
            F.min("_from").alias("start_timestamp"),
            F.max("_to").alias("end_timestamp"),
            F.max("_max").alias("max_nodes_used"),
            ratio(F.sum("_sum"), F.sum("_n")).alias("mean_nodes_used"),
        )
        .withColumn("duration_seconds", seconds_between("start_timestamp", "end_timestamp"))
        .filter(F.col("duration_seconds") >= min_seconds)
    )
    numbered = ordered_scan(settle(found), "start_timestamp", {}, keys, number="interval_no")
    return numbered.select(
        *keys,
        "interval_no",
        "start_timestamp",
        "end_timestamp",
        "duration_seconds",
        "max_nodes_used",
        "mean_nodes_used",
    )


JOB_COLUMNS = ("job_name", "nodes_used", "start_timestamp", "end_timestamp")


def jobs_running_at(df: DataFrame, at: datetime) -> DataFrame:
    """Jobs that have started by ``at`` and not yet ended."""
    moment = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    running = (F.col("start_timestamp") <= moment) & (moment < F.col("end_timestamp"))
    return df.filter(running).select(*JOB_COLUMNS)


def over_capacity_jobs(
    df: DataFrame, intervals: DataFrame, *, slices: Sequence[str] | None = None
) -> DataFrame:
    """Jobs running at the start and at the end of each interval.

    Jobs and instants meet in the nodes of a binary hierarchy of hours, so a job is a few rows
    however long it runs. Rows of nodes without an instant go first, before jobs are copied to their
    slices. ``intervals`` is read twice; the adaptive planner broadcasts few instants.
    """
    edges = F.array(
        F.struct(F.col("start_timestamp").alias("instant"), "interval_no", F.lit("start").alias("edge")),
        F.struct(F.col("end_timestamp").alias("instant"), "interval_no", F.lit("end").alias("edge")),
    )
    keys = slice_keys(slices)
    packs = packed_moments(intervals.select(*keys, F.inline(edges)), "instant", keys)
    nodes = with_nodes(valid_intervals(df).select(*JOB_COLUMNS), "start_timestamp", "end_timestamp")
    if slices:
        nodes = nodes.join(packs.select(LEVEL, NODE).distinct(), [LEVEL, NODE], "left_semi")
    nodes = with_slices(nodes, slices)
    found = moments_in_spans(nodes, packs, "instant", "start_timestamp", "end_timestamp", keys)
    return found.select(*keys, "interval_no", "edge", "instant", *JOB_COLUMNS)
