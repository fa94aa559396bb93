from datetime import date, datetime, timedelta

import pytest

from nodeledger.operators import core_hours as ch


def used(make_jobs, rows):
    return make_jobs(
        [{"queue_name": q, "start_timestamp": t, "used_core_hours": h} for q, t, h in rows]
    )


def by_queue(make_jobs, hours):
    return ch.daily_core_hours(used(make_jobs, [(q, "2024-01-01 00:00:00", h) for q, h in hours.items()]))


def test_missing_cells_are_zero(make_jobs):
    jobs = used(
        make_jobs,
        [
            ("a", "2024-01-07 10:00:00", 1.0),  # a Sunday: week of 1 January
            ("a", "2024-01-08 10:00:00", 2.0),
            ("b", "2024-01-08 11:00:00", None),
            (None, "2024-01-09 11:00:00", 9.0),
            ("b", None, 9.0),
        ],
    )
    rows = ch.weekly_core_hours(jobs).orderBy("bucket", "queue_name").collect()
    assert [tuple(r) for r in rows] == [
        (date(2024, 1, 1), "a", 1.0, 1.0),
        (date(2024, 1, 1), "b", 0.0, 1.0),
        (date(2024, 1, 8), "a", 2.0, 2.0),
        (date(2024, 1, 8), "b", 0.0, 2.0),
    ]
    wide = ch.core_hours_wide(ch.monthly_core_hours(jobs)).collect()
    assert [r.asDict() for r in wide] == [
        {"bucket": date(2024, 1, 1), "a": 3.0, "b": 0.0, "total_runtime_hours": 3.0}
    ]
    with pytest.raises(ValueError, match="queue_name"):
        ch.daily_core_hours(jobs.drop("queue_name"))


def test_top_queues_with_ties(make_jobs):
    hours = {f"q{i:02d}": 5.0 for i in range(12)}
    rows = {r.queue_label: r.core_hours for r in ch.core_hours_top_queues(by_queue(make_jobs, hours)).collect()}
    assert set(rows) == {f"q{i:02d}" for i in range(10)} | {"Other"} and rows["Other"] == 10
    few = ch.core_hours_top_queues(by_queue(make_jobs, {"a": 1.0, "b": 2.0})).collect()
    assert {r.queue_label for r in few} == {"a", "b"}


def test_cumulative_keeps_queues_of_three_percent(make_jobs):
    table = by_queue(make_jobs, {"big": 94.0, "three": 3.0, "small": 2.0, "tiny": 1.0})
    labels = {r.queue_label for r in ch.core_hours_cumulative(table, top=1).collect()}
    assert labels == {"big", "three", "Other"}
    jobs = used(make_jobs, [("a", "2024-01-01 00:00:00", 1.0), ("b", "2024-01-02 00:00:00", 4.0), ("a", "2024-01-03 00:00:00", 2.0)])
    running = ch.core_hours_cumulative(ch.daily_core_hours(jobs)).orderBy("queue_label", "bucket").collect()
    assert [r.cumulative_core_hours for r in running] == [1, 1, 3, 0, 4, 4]


def test_share_threshold_follows_the_code(make_jobs):
    table = by_queue(make_jobs, {"A": 50.0, "B": 40.0, "C": 5.0, "D": 3.0, "E": 2.0})
    rows = {r.queue_label: r.core_hours for r in ch.core_hours_share(table, 5.0).collect()}
    assert rows == {"A": 50, "B": 40, "C": 5, "Other": 5}
    exact = {r.queue_label for r in ch.core_hours_share(by_queue(make_jobs, {"A": 99.0, "B": 1.0})).collect()}
    assert exact == {"A", "B"}
    dropped = {r.queue_label for r in ch.core_hours_share(by_queue(make_jobs, {"A": 9.0, "B": 0.0})).collect()}
    assert dropped == {"A"}
    nothing = ch.core_hours_share(by_queue(make_jobs, {"A": 0.0, "B": 0.0})).collect()
    assert [(r.queue_label, r.share_percent) for r in sorted(nothing)] == [("A", None), ("B", None)]


@pytest.mark.parametrize(
    "days, granularity", [(29, "daily"), (30, "weekly"), (364, "weekly"), (365, "monthly")]
)
def test_granularity_by_whole_days(make_jobs, days, granularity):
    first = datetime(2022, 12, 20)
    last = first + timedelta(days=days, hours=23)
    jobs = used(make_jobs, [("a", str(first), 1.0), ("a", str(last), 1.0)])
    assert {r.granularity for r in ch.core_hours_auto(jobs).collect()} == {granularity}


@pytest.mark.parametrize(
    "times, expected",
    [
        (("2023-12-25 00:00:00", "2024-01-10 00:00:00"), {("all", "daily", "all")}),
        (("2024-01-05 00:00:00", "2024-02-10 00:00:00"), {("year", "weekly", "2024")}),
        (("2024-01-05 00:00:00", "2024-01-10 00:00:00"), {("month", "daily", "2024-01")}),
    ],
)
def test_scope(make_jobs, times, expected):
    jobs = used(make_jobs, [("a", t, 1.0) for t in times])
    assert {(r.scope, r.granularity, r.period) for r in ch.core_hours_scope(jobs).collect()} == expected


def test_week_between_two_years_is_in_both(make_jobs):
    jobs = used(make_jobs, [("a", "2024-12-31 00:00:00", 1.0), ("b", "2025-01-01 00:00:00", 2.0)])
    rows = ch.weekly_core_hours_by_year(jobs).collect()
    assert {(r.slice, str(r.bucket), r.queue_name, r.core_hours) for r in rows} == {
        ("2024", "2024-12-30", "a", 1.0),
        ("2025", "2024-12-30", "b", 2.0),
    }


def test_shares_sum_to_hundred_in_every_slice(make_jobs):
    jobs = used(make_jobs, [(f"q{i % 7}", f"202{i % 3}-01-01 00:00:00", float(i)) for i in range(1, 40)])
    table = ch.monthly_core_hours(jobs, slices=("all", "year"))
    sums = ch.core_hours_share(table, groups=["slice"]).groupBy("slice").sum("share_percent").collect()
    assert len(sums) == 4 and all(r[1] == pytest.approx(100) for r in sums)
