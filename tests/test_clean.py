import pytest
from pyspark.sql import functions as F

from nodeledger.operators import clean
from nodeledger.schema import CLEAN_COLUMNS


def names(df):
    return sorted((r.job_name for r in df.select("job_name").collect()), key=str)


def test_filters_keep_limits(make_jobs):
    jobs = make_jobs(
        [
            {"job_name": "at_limit", "runtime_seconds": 150.0, "walltime_seconds": 100.0},
            {"job_name": "below_limit", "runtime_seconds": 149.0, "walltime_seconds": 100.0},
            {"job_name": "no_walltime", "runtime_seconds": 0.0, "walltime_seconds": 0.0},
            {"job_name": "no_runtime", "runtime_seconds": None},
            {"job_name": "negative_hours", "used_core_hours": -1.0},
            {"job_name": "zero_hours", "used_core_hours": 0.0},
            {"job_name": "negative_runtime", "runtime_seconds": -5.0},
        ]
    )
    assert names(clean.clean_filters(jobs)) == ["below_limit", "zero_hours"]


def test_negative_wait_becomes_null(make_jobs):
    jobs = make_jobs(
        [
            {"queued_timestamp": "2024-01-01 02:00:00"},
            {"queued_timestamp": "2024-01-01 00:59:59.500000"},
            {"start_timestamp": None},
            # The clock of the session's zone jumps between these two.
            {"queued_timestamp": "2024-03-10 01:30:00", "start_timestamp": "2024-03-10 03:30:00"},
        ]
    )
    waits = [r.wait_seconds for r in clean.derive_wait(jobs).orderBy("job_name").collect()]
    assert waits == [None, 0.5, None, 7200.0]


def test_runtime_check(make_jobs):
    jobs = make_jobs([{}, {"end_timestamp": "2024-01-01 00:59:00"}])
    checks = [r.runtime_seconds_check for r in clean.runtime_check(jobs).orderBy("job_name").collect()]
    assert checks == [3600.0, None]


def test_dedup_after_filters_and_with_null_names(make_jobs):
    jobs = make_jobs(
        [
            {"job_name": "a", "queued_timestamp": "2023-12-01 00:00:00", "used_core_hours": -1.0},
            {"job_name": "a", "queued_timestamp": "2023-12-02 00:00:00", "nodes_used": 7},
            {"job_name": "a", "queued_timestamp": None, "nodes_used": 8},
            {"job_name": None, "nodes_used": 9},
            {"job_name": None, "nodes_used": 9},
        ]
    )
    kept = clean.clean_jobs(jobs)
    assert kept.columns == list(CLEAN_COLUMNS)
    assert sorted((str(r.job_name), r.nodes_used) for r in kept.collect()) == [("None", 9), ("a", 7)]


def test_one_name_holds_most_rows(spark, make_jobs):
    one = make_jobs([{"job_name": "hot"}]).drop("exit_code")
    jobs = one.crossJoin(spark.range(5000).select(F.col("id").cast("int").alias("exit_code")))
    kept = clean.dedup_jobs(jobs)
    assert [r.exit_code for r in kept.collect()] == [0]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_audit(make_jobs):
    jobs = make_jobs(
        [
            {"job_name": "a"},
            {"job_name": "a"},
            {"job_name": None},
            {"job_name": None},
            {"job_name": "b", "runtime_seconds": 1e9},
            {"job_name": "c", "runtime_seconds": -1.0},
            {"job_name": "d", "used_core_hours": -1.0},
        ]
    )
    steps = clean.cleaning_audit(jobs).orderBy("step").collect()
    assert [(r.rows_before, r.rows_after) for r in steps] == [(7, 6), (6, 5), (5, 4), (4, 2)]
    empty = clean.cleaning_audit(make_jobs([])).collect()
    assert {r.rows_after for r in empty} == {0}


def test_unreadable_text_becomes_null(spark):
    rows = spark.createDataFrame([("2024-01-02 03:04:05",), ("no time",), (None,)], "start_timestamp string")
    parsed = [r[0] for r in clean.parse_timestamps(rows).collect()]
    assert parsed[0].hour == 3 and parsed[1:] == [None, None]


def test_names_in_any_case_and_missing_columns(make_jobs):
    jobs = make_jobs([{}])
    upper = jobs.toDF(*[c.upper() for c in jobs.columns]).withColumn("EXTRA", F.lit(1))
    assert clean.normalize_columns(upper).columns == jobs.columns
    with pytest.raises(ValueError, match="exit_code"):
        clean.normalize_columns(jobs.drop("exit_code"))
    with pytest.raises(ValueError, match="exit_code"):
        clean.successful_jobs(jobs.drop("exit_code"))


def test_success_and_valid_queues(make_jobs):
    jobs = make_jobs(
        [
            {"job_name": "a", "exit_code": 0},
            {"job_name": "b", "exit_code": -29, "queue_name": "z"},
            {"job_name": "c", "exit_code": 1, "queue_name": None},
            {"job_name": "d", "exit_code": None},
        ]
    )
    assert names(clean.successful_jobs(jobs)) == ["a", "b"]
    assert names(clean.valid_queue_jobs(jobs, ["q"])) == ["a", "d"]
    dropped = clean.dropped_queue_jobs(jobs, ["q"]).first()
    assert (dropped.rows_before, dropped.rows_kept, dropped.rows_dropped) == (4, 2, 2)
    with pytest.raises(ValueError):
        clean.valid_queue_jobs(jobs, None)
    many = jobs.sparkSession.range(20_000).selectExpr("if(id = 7, 'q', concat('other', id)) queue_name")
    assert names(clean.valid_queue_jobs(jobs, many)) == ["a", "d"]
    assert clean.dropped_queue_jobs(jobs, many).first() == dropped


def test_missing_value_texts_and_times_out_of_range(spark, tmp_path):
    from nodeledger.operators.clean import clean_jobs, normalize_columns, parse_timestamps
    from nodeledger.schema import RAW_TYPES

    good = {c: "1" for c in RAW_TYPES} | {"walltime_seconds": "7200", "runtime_seconds": "3600", "exit_code": "0"}
    good |= {"queued_timestamp": "2024-01-01 00:00:00", "start_timestamp": "2024-01-01 01:00:00", "end_timestamp": "2024-01-01 02:00:00"}
    words = ("NaN", "nan", "NA", "N/A", "null", "")
    rows = [good | {c: w} for c in RAW_TYPES for w in words] + [good | {"end_timestamp": "9999-12-31 00:00:00"}]
    raw = spark.createDataFrame([tuple(r[c] for c in RAW_TYPES) for r in rows], ", ".join(f"{c} string" for c in RAW_TYPES))
    typed = parse_timestamps(normalize_columns(raw)).collect()
    for k, c in enumerate(RAW_TYPES):
        assert all(r[c] is None for r in typed[k * len(words) : (k + 1) * len(words)])
    assert typed[-1]["end_timestamp"] is None
    assert all(r.queue_name != "NaN" and r.walltime_seconds == r.walltime_seconds for r in clean_jobs(raw).collect())


def test_audit_counted_while_writing_equals_the_audit(spark, make_jobs, tmp_path):
    rows = [
        {"job_name": "a", "runtime_seconds": 9_999_999.0},
        {"job_name": "a"},
        {"job_name": "b", "runtime_seconds": -1.0},
        {"job_name": "c", "used_core_hours": None},
        {"job_name": None},
        {"job_name": None},
        {"job_name": "d"},
    ]
    raw = make_jobs(rows)
    cleaning = clean.AuditedCleaning(raw)
    cleaning.jobs.write.parquet(f"{tmp_path}/jobs")
    assert cleaning.audit().collect() == clean.cleaning_audit(raw).orderBy("step").collect()
    assert spark.read.parquet(f"{tmp_path}/jobs").count() == 3 == clean.clean_jobs(raw).count()
    nothing = clean.AuditedCleaning(raw.limit(0))
    nothing.jobs.collect()
    assert [r.rows_after for r in nothing.audit().collect()] == [0, 0, 0, 0]
