"""Text reports as tables of lines, in reading order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeledger.functions.text import (
    format_count,
    format_duration,
    format_hundredths,
    format_percent,
    format_quantity,
)
from nodeledger.operators.queue_stats import (
    efficiency_metric,
    metric_stats,
    queue_summary,
    queue_summary_totals,
    report_metrics,
)
from nodeledger.operators.slices import slice_keys
from nodeledger.schema import DURATION_METRICS, REPORT_METRICS

_RULE = "-" * 72
_HEADER, _QUEUE, _FOOTER = 0, 1, 2


def _line(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _numbered(df: DataFrame, lines: Sequence[Column], kept: Sequence) -> DataFrame:
    present = F.array_compact(F.array(*lines))
    return df.select(*kept, F.posexplode(present).alias("line_no", "line"))


def _metric_lines(metric: str, label: str) -> list[Column]:
    stats = F.try_element_at("_stats", F.lit(metric))
    if metric in DURATION_METRICS:
        def shown(name):
            return format_duration(stats[name])

        first = _line("    Mean: ", shown("mean"), "  Median: ", shown("median"))
    else:
        def shown(name):
            return format_quantity(stats[name])

        first = _line(
            "    Mean: ", shown("mean"), "  Median: ", shown("median"), "  Std: ", shown("std")
        )
    lines = [
        F.lit(f"  {label}:"),
        first,
        _line("    P5: ", shown("p5"), "  P95: ", shown("p95")),
        _line("    Min: ", shown("min"), "  Max: ", shown("max")),
    ]
    return [F.when(stats.isNotNull(), line) for line in lines]


def queue_summary_lines(
    df: DataFrame, title: str, *, slices: Sequence[str] | None = None
) -> DataFrame:
    """The per-queue report: header, one block per queue by name, overall counts.

    Sort by ``section``, ``queue_name`` and ``line_no`` for reading order.
    """
    groups = slice_keys(slices)
    totals = queue_summary_totals(df, slices=slices)
    measured = {**report_metrics(df), **efficiency_metric()}
    per_metric = metric_stats(df, measured, slices=slices)
    names = ("mean", "median", "std", "p5", "p95", "min", "max")
    stats = per_metric.groupBy(*groups, "queue_name").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct(*names)))).alias("_stats")
    )
    blocks = queue_summary(df, slices=slices).join(stats, [*groups, "queue_name"], "left")
    efficiency = F.try_element_at("_stats", F.lit("efficiency"))
    rated = efficiency.isNotNull()

    header = [
        F.lit(title),
        F.lit("=" * len(title)),
        F.lit(""),
        _line("Total jobs:       ", format_count(F.col("total_jobs"))),
        _line("Total core-hours: ", format_quantity(F.col("total_core_hours"))),
        _line("Queues:           ", F.col("n_queues").cast("string")),
        F.lit(""),
    ]
    block = [
        F.lit(_RULE),
        _line("Queue: ", F.col("queue_name")),
        F.lit(_RULE),
        _line("  Jobs:           ", format_count(F.col("n_jobs"))),
        _line(
            "  Total Core-Hrs: ",
            format_quantity(F.col("core_hours")),
            " (",
            format_hundredths(F.col("share_percent")),
            "% of total)",
        ),
        F.when(rated, F.lit("  Walltime Efficiency (runtime/walltime):")),
        F.when(
            rated,
            _line(
                "    Mean: ",
                format_percent(efficiency["mean"]),
                "  Median: ",
                format_percent(efficiency["median"]),
                "  Std: ",
                format_percent(efficiency["std"]),
            ),
        ),
        *[line for metric, label in REPORT_METRICS.items() for line in _metric_lines(metric, label)],
        _line("  Unique Users:    ", format_count(F.col("unique_users"))),
        _line("  Unique Projects: ", format_count(F.col("unique_projects"))),
        F.lit(""),
    ]
    footer = [
        _line("Total Unique Users:    ", format_count(F.col("unique_users"))),
        _line("Total Unique Projects: ", format_count(F.col("unique_projects"))),
    ]

    kept = [F.col(g) for g in groups]
    around = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(None).cast("string").alias("queue_name"),
            F.lit(i).alias("line_no"),
            line.alias("line"),
        )
        for section, lines in ((_HEADER, header), (_FOOTER, footer))
        for i, line in enumerate(lines)
    ]
    inside = _numbered(blocks, block, [*kept, F.lit(_QUEUE).alias("section"), F.col("queue_name")])
    return totals.select(*kept, F.inline(F.array(*around))).unionByName(inside)


def utilization_lines(stats: DataFrame, *, groups: Sequence[str] = ()) -> DataFrame:
    """The utilization statistics as text."""
    def level(label: str, name: str, whole: bool) -> Column:
        nodes = F.col(f"{name}_nodes")
        shown = nodes.cast("string") if whole else format_hundredths(nodes)
        return _line(label, shown, " nodes (", format_hundredths(F.col(f"{name}_percent")), " %)")

    lines = [
        _line("Max nodes available: ", F.col("capacity").cast("string")),
        level("Max utilization: ", "max", True),
        level("Min utilization: ", "min", True),
        level("Mean utilization (time-weighted): ", "mean", False),
        level("Std  utilization (time-weighted): ", "std", False),
    ]
    return _numbered(stats, lines, [F.col(g) for g in groups])


def over_capacity_lines(intervals: DataFrame, jobs: DataFrame, *, groups: Sequence[str] = ()) -> DataFrame:
    """The over-capacity report: a heading per interval, then the jobs at its start and end.

    Sort by ``groups``, ``interval_no``, ``section``, ``job_name`` and ``line_no``.
    """
    heading = [
        F.lit("=" * 80),
        _line("Over-capacity interval ", F.col("interval_no").cast("string")),
        _line("Start: ", F.col("start_timestamp").cast("string")),
        _line("End  : ", F.col("end_timestamp").cast("string")),
        _line("Duration: ", format_hundredths(F.col("duration_seconds") / 60), " min"),
        _line("Max nodes used: ", F.col("max_nodes_used").cast("string")),
        F.lit(""),
    ]
    nobody = F.lit(None).cast("string").alias("job_name")

    def fixed(lines: Sequence[Column], section: int) -> DataFrame:
        return _numbered(intervals, lines, [*groups, "interval_no", F.lit(section).alias("section"), nobody])

    entry = _line(
        "  - ",
        F.col("job_name"),
        F.format_string(": %d nodes (start: ", F.col("nodes_used")),
        F.col("start_timestamp").cast("string"),
        ", end: ",
        F.col("end_timestamp").cast("string"),
        ")",
    )
    section = F.when(F.col("edge") == "start", 2).otherwise(4).alias("section")
    listed = jobs.select(*groups, "interval_no", section, "job_name", F.lit(0).alias("line_no"), entry.alias("line"))
    return (
        fixed(heading, 0)
        .unionByName(fixed([F.lit("Jobs running at START:")], 1))
        .unionByName(listed)
        .unionByName(fixed([F.lit(""), F.lit("Jobs running at END:")], 3))
        .unionByName(fixed([F.lit("")], 5))
    )
