"""The shape of the plans: what may be scanned, moved to one task or run in Python."""

import re

import pytest

from nodeledger.operators import bins, clean, utilization
from nodeledger.operators import core_hours, queue_stats
from nodeledger.registry import catalog
from nodeledger.registry.logs import jobs
from nodeledger.sources import headers, sinks

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
# These write files or checkpoints first, so that their last plan says little.
STAGED = {
    "scan_job_logs",
    "write_clean_jobs",
    "write_partitioned_jobs",
    "utilization_grid",
    "cleaning_audit_of_writing",
    "write_filtered_by_source",
    "grid_of_machine_files",
    "job_counts",
    "core_hours_auto",
    "core_hours_auto_short",
    "core_hours_scope",
    "core_hours_scope_short",
    "core_hours_scope_by_slice",
    "over_capacity_intervals",
    "over_capacity_jobs",
    "over_capacity_lines",
    "utilization_trend",
    "utilization_trend_single_pass",
    "utilization_trend_long",
}


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return initial_plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STAGED))
def test_no_pairs_and_no_python(spark, name):
    plan = initial_plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "BatchEval"):
        assert operator not in plan


@pytest.mark.parametrize(
    "operator",
    [
        utilization.nodes_in_use,
        queue_stats.queue_metric_stats,
        core_hours.monthly_core_hours,
    ],
)
def test_steps_share_one_scan(spark, operator):
    """A log that is read by several steps of a plan is read once."""
    plan = final_plan(operator(jobs(spark, FOLDER)))
    assert plan.count("FileScan parquet [l_orderkey") <= 1 and "ReusedExchange" in plan


def test_one_task_only_scans_days(spark):
    plan = initial_plan(utilization.nodes_in_use(jobs(spark, FOLDER)))
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate(keys=[_day" in lines[i + 1] for i in single)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    log = jobs(spark, FOLDER)
    sinks.write_clean_jobs(log, f"{tmp_path}/jobs")
    written = spark.read.parquet(f"{tmp_path}/jobs")
    valid = clean.valid_queue_jobs(written, ["Brand#1", "Brand#2"]).filter("start_year = 1998")
    plan = initial_plan(core_hours.core_hours_top_queues(core_hours.monthly_core_hours(valid)))
    assert "In(queue_name, [Brand#1,Brand#2])" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*start_year[^\]]*1998", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["queue_name", "start_timestamp", "used_core_hours"]


def scans_of_written(df):
    """Scans of a written log in an executed plan; a reused shuffle reads nothing."""
    return final_plan(df).count("FileScan parquet [")


@pytest.mark.parametrize(
    "operator",
    [
        queue_stats.queue_metric_stats,
        lambda log: queue_stats.queue_metric_stats(log, slices=("all", "year", "month")),
        queue_stats.queue_efficiency,
        bins.scatter_bounds,
        lambda log: bins.scatter_bounds(log, slices=("all", "month")),
    ],
)
def test_a_written_log_is_read_once(spark, tmp_path, operator):
    sinks.write_clean_jobs(jobs(spark, FOLDER), f"{tmp_path}/jobs")
    assert scans_of_written(operator(spark.read.parquet(f"{tmp_path}/jobs"))) == 1


@pytest.mark.parametrize("slices", [None, ("all", "year", "month")])
def test_extent_and_tables_come_from_written_daily_sums(spark, slices):
    table = core_hours.core_hours_scope(jobs(spark, FOLDER), slices=slices)
    assert "FileScan" not in initial_plan(table) and "FileScan" not in final_plan(table)


def test_slices_of_statistics_copy_counts_and_not_jobs(spark, tmp_path):
    """Above the scan jobs are unpivoted and counted; the copies to slices come after that."""
    sinks.write_clean_jobs(jobs(spark, FOLDER), f"{tmp_path}/jobs")
    stats = queue_stats.queue_metric_stats(spark.read.parquet(f"{tmp_path}/jobs"), slices=("all", "year", "month"))
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    for part in plan.split("Generate explode")[1:]:
        assert "Aggregate [" in part.split("Relation")[0]


def test_tables_of_bins_read_no_job(spark):
    """The three tables of bins come from the written counts."""
    tables = bins.job_counts(jobs(spark, FOLDER), catalog.SIZES, catalog.WALLTIMES)
    assert all("FileScan" not in initial_plan(t) for t in tables.values())


def test_listing_log_files_reads_no_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 1000)
    found = headers.first_lines(spark, str(tmp_path), "*.csv", lambda name: name.isNotNull())
    assert "ReadSchema: struct<path:string>" in initial_plan(found)
    assert [(r.header, r.opened) for r in found.collect()] == [("x,y", True)]
