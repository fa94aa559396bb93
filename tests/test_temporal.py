import pytest

from nodeledger.operators import slices, temporal


def starts(make_jobs, *times):
    return make_jobs([{"start_timestamp": t} for t in times])


def test_dates_without_jobs_are_absent_and_hours_are_filled(make_jobs):
    jobs = starts(make_jobs, "2024-01-01 05:10:00", "2024-01-01 05:50:00", "2024-01-03 06:00:00", None)
    rows = temporal.hourly_counts(jobs).collect()
    assert len(rows) == 48 and {str(r.date) for r in rows} == {"2024-01-01", "2024-01-03"}
    means = {r.hour: r.mean_percent for r in temporal.hour_distribution(jobs).collect()}
    assert means[5] == 50 and means[6] == 50 and means[7] == 0


def test_weeks_share_numbers_across_years(make_jobs):
    # The first and last belong to ISO week 1, the middle one to week 52 of the year before.
    jobs = starts(make_jobs, "2024-12-31 00:00:00", "2023-01-01 00:00:00", "2023-01-03 00:00:00")
    rows = [r for r in temporal.weekday_counts(jobs).collect() if r.n_jobs]
    assert sorted((r.iso_week, r.weekday, r.n_jobs) for r in rows) == [(1, "Tuesday", 2), (52, "Sunday", 1)]


def test_one_period_has_no_deviation(make_jobs):
    jobs = starts(make_jobs, "2024-12-31 00:00:00")
    rows = temporal.dayofyear_distribution(jobs).orderBy("day_of_year").collect()
    assert len(rows) == 366 and all(r.std_percent is None and r.band_low is None for r in rows)
    assert rows[365].mean_percent == 100
    # At the end of the year only four days are in the window.
    assert rows[365].mean_smooth == pytest.approx(25) and rows[362].mean_smooth == pytest.approx(100 / 7)


def test_profile(make_jobs):
    jobs = make_jobs([{"nodes_used": 3}, {"queue_name": None, "nodes_used": 9, "start_timestamp": None}])
    row = temporal.dataset_profile(jobs).first()
    assert (row.n_jobs, row.n_queues, row.min_nodes_used, row.max_nodes_used) == (2, 1, 3, 9)


def test_slices(make_jobs):
    jobs = starts(make_jobs, "2023-12-31 23:59:59", "2024-01-01 00:00:00", None)
    found = {r.slice: r.n_jobs for r in slices.slice_counts(jobs).collect()}
    assert found == {"all": 3, "2023": 1, "2023-12": 1, "2024": 1, "2024-01": 1}
    assert sorted(map(tuple, slices.slices_present(jobs).collect())) == [(2023, 12), (2024, 1)]
    assert slices.in_period(jobs, 2024, 1).count() == 1
    with pytest.raises(ValueError):
        slices.slice_counts(jobs, ("week",))


def test_sliced_equals_filtered(make_jobs):
    jobs = starts(make_jobs, *[f"202{y}-0{m}-1{d} 0{h}:00:00" for y in (3, 4) for m in (1, 2) for d in (1, 2) for h in (3, 4, 4)])
    sliced = temporal.hour_distribution(jobs, slices=("year", "month"))
    for label, part in (("2023", slices.in_period(jobs, 2023)), ("2024-02", slices.in_period(jobs, 2024, 2))):
        expected = sorted(map(tuple, temporal.hour_distribution(part).collect()))
        got = sliced.filter(sliced.slice == label).drop("slice")
        assert sorted(map(tuple, got.collect())) == expected
