"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeledger.operators import (
    bins,
    capacity,
    clean,
    core_hours,
    queue_stats,
    report,
    slices,
    temporal,
    trend,
    utilization,
)
from nodeledger.plans.settle import checkpoint_folder, settle
from nodeledger.registry.logs import MACHINE, QUEUES, event_jobs, jobs, raw_jobs
from nodeledger.sources.joblog import read_clean_log, read_filtered_by_source, scan_job_logs
from nodeledger.sources.machine import Machine, read_machine
from nodeledger.sources.sinks import file_audit, write_clean_jobs, write_filtered_by_source

CAPACITY = MACHINE.max_nodes
SIZES, WALLTIMES = MACHINE.size_bins, MACHINE.walltime_bins
EVERY = slices.EVERY_LEVEL
# An instant in the middle of the main log, and the heading of the text report.
MOMENT = datetime(1998, 6, 15, 12, 0, 0)
TITLE = "Main Log – Detailed Queue Summary"
DECIMALS = 4

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles so that results do not depend on the order of additions.

    The limit between rounding down and up lies just below one half, so that the exact halves of
    whole-number ratios are rounded up whatever their last bit.
    """
    scale = 10.0**DECIMALS

    def rounded(name: str) -> Column:
        return F.floor(F.col(f"`{name}`") * scale + 0.500001) / scale

    return df.select(
        *[rounded(n).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def _on(log: Query, operator: Callable[..., DataFrame], *args, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(operator(log(spark, sf_dir), *args, **options))

    return run


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_queue_jobs(jobs(spark, sf_dir), QUEUES)


def _successful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.successful_jobs(jobs(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_hours.monthly_core_hours(jobs(spark, sf_dir))


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilization.nodes_in_use(jobs(spark, sf_dir))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilization.utilization_grid(_nodes(spark, sf_dir), CAPACITY)


def _event_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = utilization.nodes_in_use(event_jobs(spark, sf_dir))
    return utilization.utilization_grid(nodes, CAPACITY)


def _text_times(log: DataFrame) -> DataFrame:
    """Times as text, unreadable for every seventh order line, and parsed again."""
    unreadable = F.endswith("job_name", F.lit("-7"))
    text = {
        c: F.when(unreadable, F.lit("not a time")).otherwise(F.col(c).cast("string"))
        for c in ("queued_timestamp", "start_timestamp", "end_timestamp")
    }
    return clean.parse_timestamps(log.withColumns(text)).select("job_name", *text)


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/nodeledger-{uuid.uuid4().hex}"


def _scan_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw log as plain and gzip files in two layouts, and scan them."""
    folder = _new_folder(spark)
    raw = raw_jobs(spark, sf_dir)
    upper = raw.toDF(*[c.upper() for c in raw.columns])
    plain = F.col("EXIT_CODE") == 0
    option = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    upper.filter(plain).write.options(**option).csv(f"{folder}/plain")
    reordered = upper.filter(~plain).select(*reversed(upper.columns))
    reordered.write.options(compression="gzip", **option).csv(f"{folder}/packed")
    return comparable(scan_job_logs(spark, f"{folder}/plain", f"{folder}/packed").drop("source_file"))


def _write_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the cleaned log as sorted gzip CSV and read it back."""
    folder = _new_folder(spark)
    write_clean_jobs(jobs(spark, sf_dir), folder, "csv")
    return comparable(read_clean_log(spark, folder, "csv"))


def _write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the cleaned log in monthly folders and count the jobs of each."""
    folder = _new_folder(spark)
    write_clean_jobs(jobs(spark, sf_dir), folder)
    written = read_clean_log(spark, folder)
    return written.groupBy("start_year", "start_month").agg(F.count("*").alias("n_jobs"))


def _audit_of_writing(log: DataFrame) -> DataFrame:
    """Clean and write the log, and return the audit that its tasks counted."""
    cleaning = clean.AuditedCleaning(log)
    write_clean_jobs(cleaning.jobs, _new_folder(log.sparkSession))
    return cleaning.audit()


def _files(log: DataFrame) -> DataFrame:
    """The raw log with the file that each job would be from, one for every exit code and year."""
    year = F.coalesce(F.year("queued_timestamp").cast("string"), F.lit("none"))
    return log.withColumn("source_file", F.concat(F.lit("log_"), year, F.lit("_"), F.col("exit_code"), F.lit(".csv.gz")))


def _filtered_files(log: DataFrame) -> DataFrame:
    """Write the filtered jobs of each source file on their own and describe each written file."""
    folder = _new_folder(log.sparkSession)
    raw = _files(log)
    write_filtered_by_source(raw, folder)
    written = read_filtered_by_source(log.sparkSession, folder)
    return file_audit(raw, written)


def _machine_of_files(spark: SparkSession, sf_dir: str) -> Machine:
    """The machine's four files, written in the layout of a machine folder and read again."""
    folder = _new_folder(spark)
    top = lambda b: "infinity" if b.hi == float("inf") else str(int(b.hi))
    files = {
        "job_dimension.csv": ("name string, min string, max string", [(b.name, str(int(b.lo)), top(b)) for b in SIZES]),
        "walltime.csv": ("name string, min string, max string", [(b.name, str(int(b.lo)), top(b)) for b in WALLTIMES]),
        "max_nodes.csv": ("max_nodes string", [(str(CAPACITY),)]),
        "queue_names.csv": ("queue_name string, min_nodes string", [(q, "1") for q in QUEUES]),
    }
    for name, (schema, rows) in files.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    return read_machine(spark, folder, with_queues=True)


def _grid_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs of configured queues by the configured bins, beside the configured capacity."""
    machine = _machine_of_files(spark, sf_dir)
    valid = clean.valid_queue_jobs(jobs(spark, sf_dir), machine.queues)
    grid = bins.size_walltime_grid(valid, machine.size_bins, machine.walltime_bins)
    return comparable(grid.withColumn("capacity", F.lit(machine.max_nodes)))


def _all_counts(log: DataFrame) -> DataFrame:
    """The three tables of :func:`bins.job_counts` under each other."""
    tables = bins.job_counts(log, SIZES, WALLTIMES)
    none = F.lit(None).cast("string")
    labels = {
        "job_size": (F.col("range_label"), none),
        "walltime": (none, F.col("range_label")),
        "size_walltime": (F.col("size_label"), F.col("walltime_label")),
    }
    parts = [
        tables[part].select(F.lit(part).alias("part"), size.alias("size_label"), walltime.alias("walltime_label"), "n_jobs")
        for part, (size, walltime) in labels.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _intervals(log: DataFrame, levels=None) -> DataFrame:
    nodes = utilization.nodes_in_use(log, slices=levels, keep_bucket=True)
    return capacity.over_capacity_intervals(nodes, CAPACITY, keys=slices.slice_keys(levels))


def _running(log: DataFrame) -> DataFrame:
    """What intervals and the jobs behind them both read, written once."""
    return settle(utilization.valid_intervals(log).select(*capacity.JOB_COLUMNS))


def _interval_jobs(log: DataFrame, levels=None) -> DataFrame:
    running = _running(log)
    return capacity.over_capacity_jobs(running, settle(_intervals(running, levels)), slices=levels)


def _interval_lines(log: DataFrame, levels=None) -> DataFrame:
    running = _running(log)
    intervals = settle(_intervals(running, levels))
    behind = capacity.over_capacity_jobs(running, intervals, slices=levels)
    return report.over_capacity_lines(intervals, behind, groups=slices.slice_keys(levels))


def _stats(log: DataFrame, levels=None) -> DataFrame:
    nodes = utilization.nodes_in_use(log, slices=levels)
    return utilization.utilization_stats(nodes, CAPACITY, keys=slices.slice_keys(levels))


def _stats_without_capacity(log: DataFrame) -> DataFrame:
    largest = utilization.effective_capacity(log, 0)
    return utilization.utilization_stats(utilization.nodes_in_use(log), 0, fallback=largest)


def _grid_with_lines(log: DataFrame, levels=None) -> DataFrame:
    keys = slices.slice_keys(levels)
    nodes = utilization.nodes_in_use(log, slices=levels)
    grid = utilization.utilization_grid(nodes, CAPACITY, keys=keys).drop("grid_index")
    return utilization.with_reference_lines(grid, utilization.utilization_stats(nodes, CAPACITY, keys=keys), keys=keys)


def _sliced_grid(log: DataFrame) -> DataFrame:
    nodes = utilization.nodes_in_use(log, slices=EVERY)
    return utilization.utilization_grid(nodes, CAPACITY, keys=slices.slice_keys(EVERY))


def _rolling(grid: DataFrame, levels=None) -> DataFrame:
    return utilization.utilization_rolling(grid, keys=slices.slice_keys(levels)).drop("grid_index")


def _matrix(log: DataFrame) -> DataFrame:
    grid = bins.size_walltime_grid(log, SIZES, WALLTIMES)
    return bins.size_walltime_matrix(grid, WALLTIMES)


def queries() -> dict[str, Query]:
    by_queue = {"keys": ("queue_name",)}
    return {
        # cleaning
        "clean_jobs": _on(raw_jobs, clean.clean_jobs),
        "parse_timestamps": _on(raw_jobs, _text_times),
        "derive_wait": _on(raw_jobs, clean.derive_wait),
        "runtime_check": _on(raw_jobs, clean.runtime_check),
        "clean_filters": _on(raw_jobs, clean.clean_filters),
        "dedup_jobs": _on(raw_jobs, clean.dedup_jobs),
        "cleaning_audit": _on(raw_jobs, clean.cleaning_audit),
        "successful_jobs": _on(jobs, clean.successful_jobs),
        "valid_queue_jobs": _on(jobs, clean.valid_queue_jobs, QUEUES),
        "dropped_queue_jobs": _on(jobs, clean.dropped_queue_jobs, QUEUES),
        "cleaning_audit_of_writing": _on(raw_jobs, _audit_of_writing),
        "slices": _on(jobs, slices.slices_present),
        "slice_counts": _on(jobs, slices.slice_counts),
        # sources and sinks
        "scan_job_logs": _scan_written,
        "write_clean_jobs": _write_and_read,
        "write_partitioned_jobs": _write_partitioned,
        "write_filtered_by_source": _on(raw_jobs, _filtered_files),
        "grid_of_machine_files": _grid_of_files,
        # queue statistics
        "queue_summary": _on(jobs, queue_stats.queue_summary),
        "queue_summary_totals": _on(jobs, queue_stats.queue_summary_totals),
        "queue_efficiency": _on(jobs, queue_stats.queue_efficiency),
        "queue_metric_stats": _on(jobs, queue_stats.queue_metric_stats),
        "queue_summary_successful": _on(_successful, queue_stats.queue_summary),
        "queue_metric_stats_successful": _on(_successful, queue_stats.queue_metric_stats),
        "queue_summary_lines": _on(jobs, report.queue_summary_lines, TITLE),
        "queue_summary_by_slice": _on(jobs, queue_stats.queue_summary, slices=EVERY),
        "queue_metric_stats_by_slice": _on(jobs, queue_stats.queue_metric_stats, slices=EVERY),
        # bins and scatter tables
        "job_size_histogram": _on(jobs, bins.job_size_histogram, SIZES),
        "walltime_histogram": _on(jobs, bins.walltime_histogram, WALLTIMES),
        "size_walltime_grid": _on(jobs, bins.size_walltime_grid, SIZES, WALLTIMES),
        "size_walltime_matrix": _on(jobs, _matrix),
        "queue_job_size_histogram": _on(_valid, bins.job_size_histogram, SIZES, **by_queue),
        "queue_walltime_histogram": _on(_valid, bins.walltime_histogram, WALLTIMES, **by_queue),
        "queue_size_walltime_grid": _on(
            _valid, bins.size_walltime_grid, SIZES, WALLTIMES, **by_queue
        ),
        "job_counts": _on(jobs, _all_counts),
        "job_size_histogram_by_slice": _on(jobs, bins.job_size_histogram, SIZES, slices=EVERY),
        "walltime_histogram_by_slice": _on(jobs, bins.walltime_histogram, WALLTIMES, slices=EVERY),
        "size_walltime_grid_by_slice": _on(
            jobs, bins.size_walltime_grid, SIZES, WALLTIMES, slices=EVERY
        ),
        "scatter_points": _on(jobs, bins.scatter_points, CAPACITY),
        "queue_scatter_points": _on(_valid, bins.scatter_points, CAPACITY, **by_queue),
        "scatter_points_by_slice": _on(jobs, bins.scatter_points, CAPACITY, slices=EVERY),
        "scatter_bounds": _on(jobs, bins.scatter_bounds),
        # temporal distributions
        "hourly_counts": _on(jobs, temporal.hourly_counts),
        "weekday_counts": _on(jobs, temporal.weekday_counts),
        "dayofyear_counts": _on(jobs, temporal.dayofyear_counts),
        "hour_distribution": _on(jobs, temporal.hour_distribution),
        "weekday_distribution": _on(jobs, temporal.weekday_distribution),
        "dayofyear_distribution": _on(jobs, temporal.dayofyear_distribution),
        "hour_distribution_by_slice": _on(jobs, temporal.hour_distribution, slices=EVERY),
        "weekday_distribution_by_slice": _on(jobs, temporal.weekday_distribution, slices=EVERY),
        "dayofyear_distribution_by_slice": _on(jobs, temporal.dayofyear_distribution, slices=EVERY),
        "dataset_profile": _on(jobs, temporal.dataset_profile),
        "dataset_profile_by_slice": _on(jobs, temporal.dataset_profile, slices=EVERY),
        # core-hours
        "daily_core_hours": _on(jobs, core_hours.daily_core_hours),
        "weekly_core_hours": _on(jobs, core_hours.weekly_core_hours),
        "monthly_core_hours": _on(jobs, core_hours.monthly_core_hours),
        "monthly_core_hours_wide": _on(
            lambda spark, sf_dir: core_hours.monthly_core_hours(_valid(spark, sf_dir)),
            core_hours.core_hours_wide,
            QUEUES,
        ),
        "core_hours_top_queues": _on(_monthly, core_hours.core_hours_top_queues),
        "core_hours_cumulative": _on(_monthly, core_hours.core_hours_cumulative),
        "core_hours_share": _on(_monthly, core_hours.core_hours_share),
        "core_hours_auto": _on(jobs, core_hours.core_hours_auto),
        "core_hours_auto_short": _on(event_jobs, core_hours.core_hours_auto),
        "core_hours_scope": _on(jobs, core_hours.core_hours_scope),
        "core_hours_scope_short": _on(event_jobs, core_hours.core_hours_scope),
        "core_hours_scope_by_slice": _on(jobs, core_hours.core_hours_scope, slices=EVERY),
        "weekly_core_hours_by_year": _on(jobs, core_hours.weekly_core_hours_by_year),
        "daily_core_hours_by_month": _on(jobs, core_hours.daily_core_hours_by_month),
        # utilization
        "utilization_events": _on(jobs, utilization.utilization_events, keep=("job_name",)),
        "nodes_in_use": _on(jobs, utilization.nodes_in_use),
        "utilization_stats": _on(jobs, _stats),
        "utilization_stats_without_capacity": _on(jobs, _stats_without_capacity),
        "utilization_stats_by_slice": _on(jobs, _stats, EVERY),
        "utilization_lines": _on(lambda spark, d: _stats(jobs(spark, d)), report.utilization_lines),
        "utilization_grid": _on(jobs, _grid_with_lines),
        "utilization_rolling": _on(_grid, _rolling),
        "utilization_trend": _on(_event_grid, trend.utilization_trend),
        "utilization_trend_single_pass": _on(_event_grid, trend.utilization_trend, robust_passes=0),
        "utilization_trend_long": _on(_grid, trend.utilization_trend),
        "over_capacity_intervals": _on(jobs, _intervals),
        "over_capacity_jobs": _on(jobs, _interval_jobs),
        "over_capacity_lines": _on(jobs, _interval_lines),
        # the same for every year and month
        "utilization_lines_by_slice": _on(
            lambda spark, d: _stats(jobs(spark, d), EVERY), report.utilization_lines, groups=[slices.SLICE]
        ),
        "utilization_grid_by_slice": _on(jobs, _grid_with_lines, EVERY),
        "utilization_rolling_by_slice": _on(lambda spark, d: _sliced_grid(jobs(spark, d)), _rolling, EVERY),
        "utilization_trend_by_slice": _on(
            lambda spark, d: _sliced_grid(event_jobs(spark, d)), trend.utilization_trend, keys=[slices.SLICE]
        ),
        "over_capacity_intervals_by_slice": _on(jobs, _intervals, EVERY),
        "over_capacity_jobs_by_slice": _on(jobs, _interval_jobs, EVERY),
        "over_capacity_lines_by_slice": _on(jobs, _interval_lines, EVERY),
        "jobs_running_at": _on(jobs, capacity.jobs_running_at, MOMENT),
    }
