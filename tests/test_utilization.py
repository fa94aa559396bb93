from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nodeledger.operators import capacity, trend
from nodeledger.operators import utilization as u
from nodeledger.plans import stabbing
from nodeledger.plans.ordered_scan import ordered_scan


def span(start, end, nodes=1, **more):
    return {"start_timestamp": start, "end_timestamp": end, "nodes_used": nodes, **more}


DAY = "2024-01-01 "


def test_end_and_start_at_one_instant(make_jobs):
    jobs = make_jobs(
        [
            span(DAY + "00:00:00", DAY + "01:00:00", 4),
            span(DAY + "01:00:00", DAY + "02:00:00", 6),
            span(DAY + "03:00:00", DAY + "03:00:00", 99),
            span(DAY + "03:00:00", None, 99),
        ]
    )
    rows = u.nodes_in_use(jobs).orderBy("t").collect()
    assert [(r.t.hour, r.delta, r.nodes_in_use, r.event_no) for r in rows] == [(0, 4, 4, 1), (1, 2, 6, 2), (2, -6, 0, 3)]
    assert [r.next_t and r.next_t.hour for r in rows] == [1, 2, None]
    stats = u.utilization_stats(u.nodes_in_use(jobs), 10).first()
    assert (stats.mean_nodes, stats.std_nodes, stats.min_nodes, stats.max_nodes) == (5.0, 1.0, 0, 6)
    assert (stats.mean_percent, stats.max_percent) == (50.0, 60.0)


def test_capacity_falls_back_to_the_largest_job(make_jobs):
    jobs = make_jobs([span(DAY + "00:00:00", DAY + "01:00:00", 4), span(DAY + "02:00:00", DAY + "01:00:00", 8)])
    largest = u.effective_capacity(jobs, 0)
    assert u.utilization_stats(u.nodes_in_use(jobs), 0, fallback=largest).first().capacity == 8
    assert u.effective_capacity(jobs, 5) is None


def random_jobs(make_jobs, n, seed, seconds=400_000, longest=90_000):
    rng = np.random.default_rng(seed)
    base = datetime(2023, 12, 25)
    rows = []
    for _ in range(n):
        begin = base + timedelta(seconds=int(rng.integers(0, seconds)), microseconds=int(rng.integers(0, 3)) * 250_000)
        end = begin + timedelta(seconds=int(rng.integers(0, longest)))
        rows.append(span(str(begin), str(end), int(rng.integers(1, 20))))
    return make_jobs(rows)


def level_by_pandas(jobs):
    pdf = jobs.toPandas()
    pdf = pdf[pdf.end_timestamp > pdf.start_timestamp]
    delta = pd.concat(
        [pd.Series(pdf.nodes_used.values, index=pdf.start_timestamp), pd.Series(-pdf.nodes_used.values, index=pdf.end_timestamp)]
    )
    return delta.groupby(level=0).sum().cumsum()


def test_scan_equals_one_task(make_jobs):
    jobs = random_jobs(make_jobs, 600, 1)
    expected = level_by_pandas(jobs)
    for parts in (1, 7):
        got = u.nodes_in_use(jobs.repartition(parts)).orderBy("t").toPandas()
        assert (got.nodes_in_use.values == expected.values).all() and (got.t.values == expected.index.values).all()
        assert got.nodes_in_use.iloc[-1] == 0 and got.delta.sum() == 0
        assert (got.next_t.iloc[:-1].values == got.t.iloc[1:].values).all()


def test_a_third_of_all_jobs_at_one_instant(spark, make_jobs):
    crowd = make_jobs([span(DAY + "00:00:00", DAY + "00:10:00")]).crossJoin(spark.range(3000)).drop("id")
    jobs = crowd.unionByName(random_jobs(make_jobs, 200, 2))
    got = u.nodes_in_use(jobs).orderBy("t").toPandas()
    assert (got.nodes_in_use.values == level_by_pandas(jobs).values).all()


def test_scan_before_1970_and_with_keys(spark):
    rows = [(k, datetime(1969, 12, 31, 23, 58) + timedelta(seconds=37 * i), i) for k in "ab" for i in range(9)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, x bigint")
    got = ordered_scan(df, "t", {"total": "x"}, ["k"], following="after").orderBy("k", "t").collect()
    assert [r.total for r in got] == [sum(range(i + 1)) for i in range(9)] * 2
    assert [r.after for r in got[:8]] == [r.t for r in got[1:9]] and got[8].after is None


def test_slices_restart_and_may_run_over(make_jobs):
    jobs = make_jobs([span("2023-12-31 23:00:00", "2024-01-01 05:00:00", 3), span("2024-01-01 01:00:00", "2024-01-01 02:00:00", 5)])
    rows = u.nodes_in_use(jobs, slices=("all", "year")).orderBy("slice", "t").collect()
    assert [(r.slice, r.nodes_in_use) for r in rows] == [("2023", 3), ("2023", 0), ("2024", 5), ("2024", 0), ("all", 3), ("all", 8), ("all", 3), ("all", 0)]


def test_grid_and_rolling_equal_pandas(make_jobs):
    jobs = random_jobs(make_jobs, 80, 3)
    level = level_by_pandas(jobs)
    expected = level.resample("15min").ffill().fillna(0)
    nodes = u.nodes_in_use(jobs)
    grid = u.utilization_grid(nodes, 50)
    got = u.utilization_rolling(grid).orderBy("grid_time").toPandas()
    assert (got.grid_time.values == expected.index.values).all()
    assert (got.nodes_in_use.values == expected.values).all()
    rolling = (expected / 50 * 100).rolling("1D", min_periods=1).mean()
    assert np.allclose(got.rolling_percent.values, rolling.values)
    lines = u.with_reference_lines(grid, u.utilization_stats(nodes, 50)).first()
    assert lines.half_capacity == 50 and lines.band_high > lines.mean_percent > lines.band_low


def test_event_on_the_grid(make_jobs):
    jobs = make_jobs([span(DAY + "00:15:00", DAY + "00:30:00", 2), span(DAY + "00:31:00", DAY + "00:40:00", 1)])
    rows = u.utilization_grid(u.nodes_in_use(jobs), 2).orderBy("grid_time").collect()
    assert [(r.grid_time.minute, r.nodes_in_use) for r in rows] == [(15, 2), (30, 0)]
    late = make_jobs([span(DAY + "00:16:00", DAY + "00:40:00", 2)])
    rows = u.utilization_grid(u.nodes_in_use(late), 2).orderBy("grid_time").collect()
    assert [(r.grid_time.minute, r.nodes_in_use) for r in rows] == [(15, 0), (30, 2)]


def test_over_capacity_limits(make_jobs):
    jobs = make_jobs(
        [
            span(DAY + "00:00:00", DAY + "10:00:00", 10),  # exactly at capacity: not over
            span(DAY + "01:00:00", DAY + "01:00:59", 1),  # 59 s: left out
            span(DAY + "02:00:00", DAY + "02:01:00", 1),  # 60 s: kept
            span(DAY + "03:00:00", DAY + "04:00:00", 5),
            span(DAY + "03:30:00", DAY + "04:00:00", 5),
        ]
    )
    rows = capacity.over_capacity_intervals(u.nodes_in_use(jobs), 10).orderBy("interval_no").collect()
    assert [(r.interval_no, r.start_timestamp.hour, r.duration_seconds, r.max_nodes_used) for r in rows] == [(1, 2, 60.0, 11), (2, 3, 3600.0, 20)]
    assert rows[0].mean_nodes_used == 10.5 and rows[1].mean_nodes_used == 15.0


@pytest.mark.parametrize("limit", [1000, 1])
def test_over_capacity_jobs_equal_direct_search(make_jobs, monkeypatch, limit):
    monkeypatch.setattr(stabbing, "MOMENTS_TOGETHER", limit)
    jobs = random_jobs(make_jobs, 150, 4)
    intervals = capacity.over_capacity_intervals(u.nodes_in_use(jobs), 180)
    rows = intervals.collect()
    assert len(rows) > 3
    expected = set()
    for r in rows:
        for edge, at in (("start", r.start_timestamp), ("end", r.end_timestamp)):
            expected |= {(r.interval_no, edge, j.job_name) for j in capacity.jobs_running_at(jobs, at).collect()}
    found = capacity.over_capacity_jobs(jobs, intervals).collect()
    assert len(found) == len(expected) and {(r.interval_no, r.edge, r.job_name) for r in found} == expected


def direct_lowess(y, fraction, passes):
    n = len(y)
    k = int(n * fraction + 1e-10)
    x = np.arange(n, dtype=float)
    robust = np.ones(n)
    for p in range(passes + 1):
        fitted = np.empty(n)
        for i in range(n):
            left = min(max(i - k // 2, 0), n - k)
            near = slice(left, left + k)
            h = max(i - left, left + k - 1 - i)
            w = (1 - (np.abs(x[near] - i) / h) ** 3) ** 3 * robust[near]
            slope, level = np.polyfit(x[near] - i, y[near], 1, w=np.sqrt(np.maximum(w, 0)))
            fitted[i] = level
        scaled = np.minimum(np.abs(y - fitted) / (6 * np.median(np.abs(y - fitted))), 1)
        robust = (1 - scaled**2) ** 2
    return fitted


@pytest.mark.parametrize("n, fraction, passes", [(300, 0.1, 0), (301, 0.11, 3), (1400, 0.05, 2), (700, 0.9, 1)])
def test_trend_equals_direct_fit(spark, n, fraction, passes):
    rng = np.random.default_rng(n)
    y = 50 + 20 * np.sin(np.arange(n) / 40) + rng.normal(0, 5, n)
    y[::37] += 60
    start = datetime(2024, 1, 1)
    rows = [(1000 + i, start + timedelta(minutes=15 * i), float(v)) for i, v in enumerate(y)]
    grid = spark.createDataFrame(rows, "grid_index bigint, grid_time timestamp_ntz, utilization_percent double")
    got = trend.utilization_trend(grid, fraction=fraction, robust_passes=passes).orderBy("grid_time").toPandas()
    assert len(got) == n
    assert np.allclose(got.trend_percent.values, direct_lowess(y, fraction, passes), rtol=1e-7, atol=1e-7)


def test_short_series_has_no_trend(make_jobs):
    jobs = make_jobs([span(DAY + "00:00:00", DAY + "04:00:00", 2)])
    rows = trend.utilization_trend(u.utilization_grid(u.nodes_in_use(jobs), 2)).collect()
    assert len(rows) == 17 and all(r.trend_percent is None for r in rows)


def test_trend_per_slice(make_jobs):
    jobs = random_jobs(make_jobs, 120, 5, seconds=1_200_000)
    keys = ["slice"]
    grid = u.utilization_grid(u.nodes_in_use(jobs, slices=("all", "year")), 50, keys=keys)
    both = trend.utilization_trend(grid, keys=keys, fraction=0.05)
    alone = trend.utilization_trend(
        u.utilization_grid(u.nodes_in_use(jobs.filter(F.year("start_timestamp") == 2024)), 50), fraction=0.05
    )
    a = both.filter("slice = '2024'").orderBy("grid_time").toPandas()
    b = alone.orderBy("grid_time").toPandas()
    assert len(a) == len(b) > 100 and np.allclose(a.trend_percent, b.trend_percent)


def test_jobs_at_more_moments_than_travel_together(make_jobs, monkeypatch):
    monkeypatch.setattr(stabbing, "MOMENTS_TOGETHER", 2)
    peaks = [span(DAY + f"0{h}:00:00", DAY + f"0{h}:30:00", 20) for h in range(1, 6)]
    jobs = make_jobs([span(DAY + "00:00:00", DAY + "09:00:00", 5), *peaks])
    intervals = capacity.over_capacity_intervals(u.nodes_in_use(jobs), 12)
    edges = {(r.interval_no, e, r[f"{e}_timestamp"]) for r in intervals.collect() for e in ("start", "end")}
    runs = jobs.filter("nodes_used > 0 and start_timestamp < end_timestamp").collect()
    expected = sorted((n, e, j.job_name) for n, e, t in edges for j in runs if j.start_timestamp <= t < j.end_timestamp)
    found = capacity.over_capacity_jobs(jobs, intervals).collect()
    assert sorted((r.interval_no, r.edge, r.job_name) for r in found) == expected and len(edges) == 10


def test_covering_nodes_are_few_and_cover_each_unit_once(spark):
    ends = [(0, 0), (0, 1), (5, 5), (7, 8), (-3, 4), (-17, -2), (1, 1022), (0, 1023), (123, 4567), (2_000_000, 3_753_000), (-(2**22), 2**22)]
    rows = spark.createDataFrame(ends, "a bigint, b bigint").select("a", "b", stabbing.covering_nodes("a", "b").alias("nodes")).collect()
    for r in rows:
        spans = sorted((n["_node"] << n["_level"], (n["_node"] + 1) << n["_level"]) for n in r.nodes)
        assert spans[0][0] == r.a and spans[-1][1] == r.b + 1
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 2 * max(1, (r.b - r.a + 1).bit_length())


def test_jobs_of_centuries_are_few_rows(make_jobs):
    """A job from 1700 to 2200 that two short peaks meet, and one of half a second."""
    jobs = make_jobs([span("1700-01-01 00:00:00", "2200-01-01 00:00:00", 5), span(DAY + "01:00:00", DAY + "02:00:00", 9), span(DAY + "01:00:00.5", DAY + "01:00:01", 9)])
    nodes = stabbing.with_nodes(jobs.select("job_name", "start_timestamp", "end_timestamp"), "start_timestamp", "end_timestamp")
    counts = sorted(r["count"] for r in nodes.groupBy("job_name").count().collect())
    assert counts[-1] <= 45 and counts[0] == 1
    intervals = capacity.over_capacity_intervals(u.nodes_in_use(jobs), 10)
    found = {(r.edge, r.job_name) for r in capacity.over_capacity_jobs(jobs, intervals).collect()}
    assert found == {("start", "j0"), ("start", "j1"), ("end", "j0")}


def test_interval_jobs_by_slice_equal_each_slice_alone(make_jobs):
    jobs = random_jobs(make_jobs, 200, 9, seconds=6_000_000)
    levels = ("all", "year", "month")
    by_slice = capacity.over_capacity_intervals(u.nodes_in_use(jobs, slices=levels), 60, keys=["slice"])
    found = capacity.over_capacity_jobs(jobs, by_slice, slices=levels).collect()
    assert len({r.slice for r in found}) > 2
    for name in {r.slice for r in found}:
        alone = jobs if name == "all" else jobs.filter(F.date_format("start_timestamp", "yyyy-MM").startswith(name))
        expected = capacity.over_capacity_jobs(alone, capacity.over_capacity_intervals(u.nodes_in_use(alone), 60)).collect()
        assert sorted((r.interval_no, r.edge, r.job_name) for r in found if r.slice == name) == sorted((r.interval_no, r.edge, r.job_name) for r in expected)


def test_grid_across_a_gap_of_centuries(make_jobs):
    """One row's gap of 238 years is cut into days before points; 8 million points, none lost."""
    jobs = make_jobs([span(DAY + "00:00:00", DAY + "01:00:00", 2), span("2262-01-01 00:00:00", "2262-01-01 02:00:00", 3)])
    grid = u.utilization_grid(u.nodes_in_use(jobs), 10)
    row = grid.agg(F.count("*"), F.min("grid_index"), F.max("grid_index"), F.count_distinct("grid_index"), F.sum("nodes_in_use")).first()
    assert row[0] == row[3] == row[2] - row[1] + 1 > 8_000_000
    assert row[4] == 4 * 2 + 8 * 3
