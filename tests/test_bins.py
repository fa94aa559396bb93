import pytest

from nodeledger.operators import bins
from nodeledger.sources.machine import Bin

INF = float("inf")
SIZES = (Bin("s", 1, 10), Bin("m", 11, 24), Bin("l", 100, 496))
TIMES = (Bin("a", 1, 60), Bin("b", 61, 600), Bin("z", 259201, INF))


def counts(df, *keys):
    return {tuple(r[k] for k in (*keys, "range_label")): r.n_jobs for r in df.collect()}


def test_bounds_gaps_and_infinity(make_jobs):
    jobs = make_jobs([{"walltime_seconds": w} for w in (1.0, 60.0, 60.5, 61.0, 600.0, 700.0, 1e9, None)])
    found = counts(bins.walltime_histogram(jobs, TIMES))
    assert found == {("1-60",): 2, ("61-600",): 2, ("259201-infinity",): 1}


def test_share_of_binned_jobs_and_empty_bins(make_jobs):
    jobs = make_jobs([{"nodes_used": n} for n in (1, 10, 11, 50, 99)])
    rows = {r.bin_name: r for r in bins.job_size_histogram(jobs, SIZES).collect()}
    assert rows["l"].n_jobs == 0 and rows["l"].percent == 0
    assert rows["s"].percent == pytest.approx(200 / 3) and rows["m"].share == pytest.approx(1 / 3)


def test_nothing_binned_gives_null_percent(make_jobs):
    jobs = make_jobs([{"nodes_used": 5000, "queue_name": "big"}, {"nodes_used": 1, "queue_name": "small"}])
    rows = bins.job_size_histogram(jobs, SIZES, keys=("queue_name",)).collect()
    assert len(rows) == 6
    assert all(r.n_jobs == 0 and r.percent is None for r in rows if r.queue_name == "big")
    assert [r.n_jobs for r in bins.job_size_histogram(make_jobs([]), SIZES).collect()] == [0, 0, 0]


def test_overlapping_bins_count_twice(make_jobs):
    both = (Bin("low", 1, 10), Bin("wide", 5, 20))
    jobs = make_jobs([{"nodes_used": n} for n in (1, 7, 15, 30)])
    assert counts(bins.job_size_histogram(jobs, both)) == {("1-10",): 2, ("5-20",): 2}
    grid = bins.size_walltime_grid(jobs, both, both).collect()
    assert len(grid) == 4 and sum(r.n_jobs for r in grid) == 0


def test_order_follows_lower_bound(make_jobs):
    shuffled = (TIMES[2], TIMES[0], TIMES[1])
    rows = bins.walltime_histogram(make_jobs([{}]), shuffled).orderBy("bin_order").collect()
    assert [r.bin_name for r in rows] == ["a", "b", "z"]


def test_grid_sums_to_histograms(make_jobs):
    jobs = make_jobs(
        [{"nodes_used": n, "walltime_seconds": w} for n in (1, 11, 300) for w in (30.0, 500.0, 300000.0)]
    )
    grid = bins.size_walltime_grid(jobs, SIZES, TIMES)
    by_size = {r[0]: r[1] for r in grid.groupBy("size_label").sum("n_jobs").collect()}
    assert by_size == {k[0]: v for k, v in counts(bins.job_size_histogram(jobs, SIZES)).items()}


def test_matrix_hides_zero_and_empty_maps(make_jobs):
    jobs = make_jobs([{"nodes_used": 1, "walltime_seconds": 30.0}, {"nodes_used": 2, "walltime_seconds": 40.0}])
    grid = bins.size_walltime_grid(jobs, SIZES, TIMES)
    rows = bins.size_walltime_matrix(grid, TIMES).orderBy("size_bin").collect()
    assert rows[0]["1s–1m"] == 2 and rows[0][">72h"] is None and rows[0].max_cell == 2
    nothing = bins.size_walltime_grid(make_jobs([{"nodes_used": 50}]), SIZES, TIMES)
    assert bins.size_walltime_matrix(nothing, TIMES).count() == 0


def test_scatter_points(make_jobs):
    jobs = make_jobs(
        [
            {"walltime_seconds": 99.0},
            {"walltime_seconds": 100.0, "nodes_used": 1},
            {"walltime_seconds": 500.0, "nodes_used": 100, "queued_timestamp": "2023-12-31 23:00:00"},
        ]
    )
    points = bins.scatter_points(jobs, 100).orderBy("walltime_seconds").collect()
    assert [(r.walltime_seconds, r.marker_size) for r in points] == [(100.0, 5.0), (500.0, 500.0)]
    assert {r.marker_size for r in bins.scatter_points(jobs, 1).collect()} == {5.0}
    # Started in January but queued in December: only in the full range.
    sliced = bins.scatter_points(jobs, 100, slices=("all", "year", "month")).collect()
    assert sorted(r.slice for r in sliced) == ["2024", "2024-01", "all", "all"]
    limits = bins.scatter_bounds(jobs).first()
    assert limits.walltime_top == pytest.approx(550.0) and limits.first_queued.year == 2023
    by_slice = {r.slice: r for r in bins.scatter_bounds(jobs, slices=("all", "year", "month")).collect()}
    assert sorted(by_slice) == ["2024", "2024-01", "all"] and by_slice["all"].first_queued.year == 2023
    assert by_slice["2024"].first_queued.year == 2024 and by_slice["2024-01"].walltime_top == pytest.approx(550.0)


def test_labels():
    assert Bin("x", 300, 1800).duration_label == "5m–30m"
    assert Bin("x", 259201, INF).duration_label == ">72h"
    assert Bin("x", 1, 60).label == "1-60"
