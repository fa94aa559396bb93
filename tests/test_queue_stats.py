import numpy as np
import pytest
from pyspark.sql import functions as F

from nodeledger.operators import queue_stats, report
from nodeledger.plans import quantiles
from nodeledger.plans.quantiles import exact_quantiles


def test_summary_counts_jobs_without_queue_in_totals_only(make_jobs):
    jobs = make_jobs(
        [
            {"queue_name": "a", "used_core_hours": 1.0, "username_genid": "x"},
            {"queue_name": "b", "used_core_hours": 2.0, "username_genid": "x"},
            {"queue_name": None, "used_core_hours": 1.0, "username_genid": "y"},
        ]
    )
    totals = queue_stats.queue_summary_totals(jobs).first()
    assert (totals.total_jobs, totals.total_core_hours, totals.n_queues, totals.unique_users) == (3, 4.0, 2, 2)
    rows = {r.queue_name: r.share_percent for r in queue_stats.queue_summary(jobs).collect()}
    assert rows == {"a": 25.0, "b": 50.0}
    free = make_jobs([{"used_core_hours": 0.0}])
    assert queue_stats.queue_summary(free).first().share_percent == 0


def test_efficiency_ignores_zero_walltime(make_jobs):
    jobs = make_jobs(
        [
            {"runtime_seconds": 50.0, "walltime_seconds": 100.0},
            {"runtime_seconds": 5.0, "walltime_seconds": 0.0},
        ]
    )
    row = queue_stats.queue_efficiency(jobs).first()
    assert (row.n_jobs, row.mean_efficiency, row.median_efficiency, row.std_efficiency) == (1, 0.5, 0.5, None)


def test_metric_without_values_has_no_row(make_jobs):
    jobs = make_jobs([{"nodes_requested": None}, {"nodes_requested": None}])
    metrics = {r.metric for r in queue_stats.queue_metric_stats(jobs).collect()}
    assert "nodes_requested" not in metrics and "nodes_used" in metrics


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy_with_a_hot_group(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {
        "hot": np.round(rng.lognormal(3, 2, 5000), 3),
        "ties": rng.integers(-3, 4, 200).astype(float),
        "one": np.array([7.25]),
        "negative": -rng.random(101) * 1e6,
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    probabilities = {"a": 0.0, "p5": 0.05, "m": 0.5, "p95": 0.95, "z": 1.0}
    for r in exact_quantiles(counts, ["g"], "v", "n", probabilities).collect():
        expected = np.quantile(groups[r.g], list(probabilities.values()))
        assert [r[q] for q in probabilities] == pytest.approx(list(expected), rel=1e-12, abs=1e-12)


def test_report_lines(make_jobs):
    jobs = make_jobs(
        [
            {"job_name": f"j{i}", "used_core_hours": 1234.5, "walltime_seconds": 7200.0, "runtime_seconds": 3661.9}
            for i in range(2)
        ]
    ).withColumn("wait_seconds", F.lit(None).cast("double"))
    lines = report.queue_summary_lines(jobs, "Title").orderBy("section", "queue_name", "line_no")
    text = [r.line for r in lines.collect()]
    assert text[:3] == ["Title", "=====", ""]
    assert "Total core-hours: 2,469.00" in text
    assert "    Mean: 1h 1m 1s  Median: 1h 1m 1s" in text
    assert "  Total Core-Hrs: 2,469.00 (100.00% of total)" in text
    assert "  Wait Time:" not in text
    assert text[-2:] == ["Total Unique Users:    1", "Total Unique Projects: 1"]


def test_number_formats(spark):
    from nodeledger.functions.text import format_duration, format_percent, format_quantity

    rows = spark.createDataFrame([(0.0,), (0.5,), (1234.5,), (-2.0,), (None,)], "x double")
    assert [r[0] for r in rows.select(format_quantity(F.col("x"))).collect()] == [
        "0.0000",
        "0.5000",
        "1,234.50",
        "-2.00",
        "N/A",
    ]
    times = spark.createDataFrame([(3661.9,), (59.0,), (None,)], "x double")
    assert [r[0] for r in times.select(format_duration(F.col("x"))).collect()] == ["1h 1m 1s", "0h 0m 59s", "N/A"]
    ratios = spark.createDataFrame([(0.72335,), (None,)], "x double")
    assert [r[0] for r in ratios.select(format_percent(F.col("x"))).collect()] == [f"{72.335:.2f}%", "nan%"]


def test_moments_of_values_far_from_zero(spark):
    """A deviation of one beside a mean of a billion, and one value in a group by itself."""
    rng = np.random.default_rng(3)
    values = np.concatenate([1e9 + rng.normal(0, 1, 4000), [-5.0]])
    rows = [("far", float(v)) for v in values[:-1]] + [("one", -5.0), ("mixed", -3.0), ("mixed", 3.0), ("mixed", 0.0), ("mixed", 3.0)]
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    found = {r.k: r for r in quantiles.described(counts, ["k"], "v", "n", {"median": 0.5}).collect()}
    far = found["far"]
    assert far.n_values == 4000 and np.isclose(far.mean, values[:-1].mean(), rtol=1e-15, atol=0)
    assert np.isclose(far.std, values[:-1].std(ddof=1), rtol=1e-6) and np.isclose(far.median, np.median(values[:-1]), rtol=1e-15)
    assert (found["one"].std, found["one"].mean, found["one"].median) == (None, -5.0, -5.0)
    mixed = found["mixed"]
    assert np.isclose(mixed.mean, 0.75) and np.isclose(mixed.std, np.std([-3, 3, 0, 3], ddof=1)) and (mixed.min, mixed.max) == (-3.0, 3.0)
