"""Rows are copied to their slices in the tasks that scan them, and not shuffled after that."""

import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from nodeledger.operators import capacity, queue_stats
from nodeledger.operators import utilization as u
from nodeledger.plans.ordered_scan import ordered_scan

LEVELS = ("all", "year", "month")


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def jobs(make_jobs):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        begin = datetime(2023, 12, 20) + timedelta(seconds=int(rng.integers(0, 200)) * 9000)
        end = begin + timedelta(seconds=int(rng.integers(1, 20)) * 9000)
        rows.append({"start_timestamp": str(begin), "end_timestamp": str(end), "nodes_used": int(rng.integers(1, 20)), "queue_name": f"q{i % 3}", "runtime_seconds": float(i % 40)})
    return make_jobs(rows)


def test_changes_are_shuffled_before_they_are_copied(jobs):
    """F6, F7, F8: no shuffle of instants holds their slice."""
    plan = initial_plan(u.utilization_stats(u.nodes_in_use(jobs, slices=LEVELS), 50, keys=["slice"]))
    assert not re.search(r"hashpartitioning\(slice#\d+, t#", plan)
    assert not re.search(r"hashpartitioning\(slice#\d+, _bucket#", plan)


def test_numbers_nobody_reads_are_not_counted(jobs):
    nodes = u.nodes_in_use(jobs, slices=LEVELS)
    assert "distinct" in initial_plan(nodes)
    assert "distinct" not in initial_plan(u.utilization_stats(nodes, 50, keys=["slice"]))


def test_each_slice_equals_its_jobs_alone(jobs):
    """Instants that jobs of several months share are one row of the year and of the full range."""
    got = u.nodes_in_use(jobs, slices=LEVELS).collect()
    assert len({r.slice for r in got}) == 5
    for name in {r.slice for r in got}:
        alone = jobs if name == "all" else jobs.filter(F.date_format("start_timestamp", "yyyy-MM").startswith(name))
        columns = ("t", "delta", "nodes_in_use", "event_no", "next_t")
        expected = sorted(tuple(r[c] for c in columns) for r in u.nodes_in_use(alone).collect())
        assert sorted(tuple(r[c] for c in columns) for r in got if r.slice == name) == expected


def test_copies_at_one_instant_are_added_up(spark):
    at = datetime(2024, 1, 1)
    rows = [("a", at, 1), ("b", at, 2), ("a", at + timedelta(days=2), 4)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, x bigint")
    both = lambda d: d.withColumn("k", F.explode(F.array("g", F.lit("all")))).drop("g")
    got = ordered_scan(df, "t", {"total": "x"}, ["k"], following="after", number="no", spread=both).orderBy("k", "t").collect()
    assert [(r.k, r.x, r.total, r.no) for r in got] == [("a", 1, 1, 1), ("a", 4, 5, 2), ("all", 3, 3, 1), ("all", 4, 7, 2), ("b", 2, 2, 1)]
    assert [r.after and r.after.day for r in got] == [3, None, 3, None, None]


def test_one_interval_over_many_buckets_is_written_in_pieces(make_jobs):
    """numbering reads the written pieces, not the instants."""
    begin = datetime(2024, 1, 30)
    rows = [{"start_timestamp": str(begin), "end_timestamp": str(begin + timedelta(days=5)), "nodes_used": 11}]
    rows += [{"start_timestamp": str(begin + timedelta(hours=7 * i)), "end_timestamp": str(begin + timedelta(hours=7 * i + 1)), "nodes_used": i} for i in range(1, 17)]
    nodes = u.nodes_in_use(make_jobs(rows), slices=LEVELS, keep_bucket=True)
    found = capacity.over_capacity_intervals(nodes, 10, keys=["slice"])
    assert "inline" not in initial_plan(found)
    whole = next(r for r in found.collect() if r.slice == "all")
    levels = [11] + [n for i in range(1, 17) for n in (11 + i, 11)] + [0]
    assert (whole.interval_no, whole.duration_seconds, whole.max_nodes_used) == (1, 5 * 86400.0, 27)
    assert whole.mean_nodes_used == pytest.approx(sum(levels) / len(levels))


def test_value_counts_are_shuffled_before_they_are_copied(jobs):
    """no shuffle by slice and value; a value that several months have counts once for each."""
    stats = queue_stats.queue_metric_stats(jobs, slices=LEVELS)
    assert not re.search(r"hashpartitioning\(slice#[^)]*value#", initial_plan(stats))
    whole = {(r.queue_name, r.metric): r for r in stats.filter("slice = 'all'").collect()}
    for r in queue_stats.queue_metric_stats(jobs).collect():
        same = whole[r.queue_name, r.metric]
        assert [same[c] for c in ("n_values", "median", "p5", "p95", "min", "max")] == [r[c] for c in ("n_values", "median", "p5", "p95", "min", "max")]
        assert same["mean"] == pytest.approx(r["mean"])


def shuffled_rows(df):
    """The partitioning of each shuffle of an executed plan and the rows it wrote; a reused one writes nothing."""
    df.collect()
    found, open_nodes = [], [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found.append((node.outputPartitioning().toString(), node.metrics().apply("shuffleRecordsWritten").value()))
        if kind == "AdaptiveSparkPlanExec":
            open_nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            open_nodes.append(node.plan())
        elif kind != "ReusedExchangeExec":
            open_nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture(scope="module")
def many_values(make_jobs):
    """Three months of jobs of one queue whose runtimes all differ."""
    months = ("2023-11", "2023-12", "2024-01")
    return make_jobs([{"start_timestamp": f"{months[i % 3]}-05 00:00:00", "runtime_seconds": 3600 + i * 0.8} for i in range(4500)])


def test_statistics_shuffle_counts_once_and_by_slice_only_sums_of_buckets(many_values):
    """F1 of round 4: copies of counts filled the disk, by slice and bucket and once more for the quantiles."""
    stats = queue_stats.metric_stats(many_values, {"runtime": F.col("runtime_seconds")}, slices=LEVELS)
    shuffles = shuffled_rows(stats)
    assert sum(rows == 4500 for _, rows in shuffles) == 2, "counted, then dealt by bucket"
    others = sum(rows for _, rows in shuffles if rows != 4500)
    assert others < 1000 and not any("slice" in by and "_bucket" in by for by, _ in shuffles)


def test_statistics_by_slice_of_values_far_from_zero(make_jobs):
    """One month lies within a billionth of its mean, in a bucket that other months share; ties, negatives, no start."""
    rng = np.random.default_rng(8)
    values = {
        "2023-11": 1e9 + rng.normal(0, 1, 300),
        "2023-12": np.concatenate([1e9 - rng.random(40) * 2e7, np.full(30, 7.0), -rng.random(25) * 50]),
        "2024-01": np.array([3.0]),
        None: np.array([0.0, 5.5, 5.5]),
    }
    rows = [{"start_timestamp": m and f"{m}-01 00:00:00", "used_core_hours": float(v)} for m, many in values.items() for v in many]
    stats = queue_stats.metric_stats(make_jobs(rows), {"hours": F.col("used_core_hours")}, slices=LEVELS)
    months = {m: v for m, v in values.items() if m}
    expected = months | {"all": np.concatenate(list(values.values())), "2023": np.concatenate([months["2023-11"], months["2023-12"]]), "2024": months["2024-01"]}
    found = {r.slice: r for r in stats.collect()}
    assert set(found) == set(expected)
    for name, v in expected.items():
        r = found[name]
        assert (r.queue_name, r.metric, r.n_values, r.min, r.max) == ("q", "hours", len(v), v.min(), v.max())
        assert [r.mean, r.p5, r.median, r.p95] == pytest.approx([v.mean(), *np.quantile(v, [0.05, 0.5, 0.95])], rel=1e-14)
        assert r["std"] == (None if len(v) == 1 else pytest.approx(v.std(ddof=1), rel=1e-6))
