"""The whole analysis of a cleaned log, as a set of named result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from nodeledger.operators import (
    bins,
    capacity,
    clean,
    core_hours,
    queue_stats,
    report,
    temporal,
    trend,
    utilization,
)
from nodeledger.operators.slices import slice_keys, slices_present
from nodeledger.plans.settle import settle
from nodeledger.sources.machine import Machine


def analyse(
    jobs: DataFrame,
    machine: Machine,
    name: str = "",
    *,
    slices: Sequence[str] | None = None,
    queue_analysis: bool = False,
    full_queue_analysis: bool = False,
    machine_utilization: bool = False,
) -> dict[str, DataFrame]:
    """All result tables for the full range (``slices=None``) or for every requested slice.

    ``jobs`` is read several times: pass a cleaned log that has been written, not the raw scan.
    """
    results = _distributions(jobs, machine, slices)
    if full_queue_analysis:
        results |= _per_queue_distributions(jobs, machine, slices)
    if queue_analysis:
        results |= _queue_analysis(jobs, machine, name, slices)
    if machine_utilization:
        results |= _utilization(jobs, machine, slices)
    return results


def _distributions(jobs, machine, slices):
    counts = bins.job_counts(jobs, machine.size_bins, machine.walltime_bins, slices=slices)
    return {
        "dataset_profile": temporal.dataset_profile(jobs, slices=slices),
        "slices": slices_present(jobs),
        "hour_distribution": temporal.hour_distribution(jobs, slices=slices),
        "weekday_distribution": temporal.weekday_distribution(jobs, slices=slices),
        "dayofyear_distribution": temporal.dayofyear_distribution(jobs, slices=slices),
        "job_size_histogram": counts["job_size"],
        "walltime_histogram": counts["walltime"],
        "size_walltime_matrix": bins.size_walltime_matrix(
            counts["size_walltime"], machine.walltime_bins, groups=slice_keys(slices)
        ),
        "scatter_points": bins.scatter_points(jobs, machine.max_nodes, slices=slices),
    }


def _per_queue_distributions(jobs, machine, slices):
    valid = clean.valid_queue_jobs(jobs, machine.queues)
    by_queue = {"keys": ("queue_name",), "slices": slices}
    counts = bins.job_counts(valid, machine.size_bins, machine.walltime_bins, **by_queue)
    return {
        "queue_job_size_histogram": counts["job_size"],
        "queue_walltime_histogram": counts["walltime"],
        "queue_size_walltime_matrix": bins.size_walltime_matrix(
            counts["size_walltime"], machine.walltime_bins, groups=[*slice_keys(slices), "queue_name"]
        ),
        "queue_scatter_points": bins.scatter_points(valid, machine.max_nodes, **by_queue),
    }


def _queue_analysis(jobs, machine, name, slices):
    valid = clean.valid_queue_jobs(jobs, machine.queues)
    successful = clean.successful_jobs(valid)
    groups = [*slice_keys(slices), *core_hours.SCOPE_KEYS]
    table = settle(core_hours.core_hours_scope(valid, slices=slices))
    results = {"core_hours": table}
    for chart, data in core_hours.core_hours_charts(table, groups=groups).items():
        results[f"core_hours_{chart}"] = data
    title = f"{name} – Detailed Queue Summary"
    results["queue_summary"] = queue_stats.queue_summary(valid, slices=slices)
    results["queue_summary_lines"] = report.queue_summary_lines(valid, title, slices=slices)
    results["queue_summary_successful"] = queue_stats.queue_summary(successful, slices=slices)
    results["queue_summary_lines_successful"] = report.queue_summary_lines(
        successful, f"{title} (Successful Jobs Only)", slices=slices
    )
    return results


def _utilization(jobs, machine, slices):
    keys = slice_keys(slices)
    nodes = settle(utilization.nodes_in_use(jobs, slices=slices))
    fallback = utilization.effective_capacity(jobs, machine.max_nodes, slices=slices)
    limits = {"fallback": fallback, "keys": keys}
    stats = utilization.utilization_stats(nodes, machine.max_nodes, **limits)
    grid = settle(utilization.utilization_grid(nodes, machine.max_nodes, **limits))
    intervals = settle(capacity.over_capacity_intervals(nodes, machine.max_nodes, **limits))
    behind = settle(capacity.over_capacity_jobs(jobs, intervals, slices=slices))
    return {
        "utilization_stats": stats,
        "utilization_lines": report.utilization_lines(stats, groups=keys),
        "utilization_grid": utilization.with_reference_lines(grid, stats, keys=keys),
        "utilization_rolling": utilization.utilization_rolling(grid, keys=keys),
        "utilization_trend": trend.utilization_trend(grid, keys=keys),
        "over_capacity_intervals": intervals,
        "over_capacity_jobs": behind,
        "over_capacity_lines": report.over_capacity_lines(intervals, behind, groups=keys),
    }
