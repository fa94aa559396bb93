import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from nodeledger.analysis import analyse
from nodeledger.operators import capacity, report
from nodeledger.operators import utilization as u
from nodeledger.operators.clean import clean_jobs
from nodeledger.schema import RAW_TYPES
from nodeledger.sources import headers, joblog, machine, sinks


def write(path, text, packed=False):
    with gzip.open(path, "wt") if packed else open(path, "w") as f:
        f.write(text)


def csv(header, *rows):
    return "\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n"


HEADER = [c.upper() for c in RAW_TYPES]
ROW = ["j1", "u", "p", "q", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 02:00:00", "7200", "3600.5", "1", "2.0", "3.5", "0"]


def test_scan_skips_other_files_and_reads_by_name(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    write(one / "a.csv", csv(HEADER, ROW))
    bad = ["j2", *ROW[1:4], "never", "2024-01-05", "", "x", *ROW[8:]]
    write(one / "b.csv.gz", csv(HEADER, bad), packed=True)
    write(one / "job_dimension.csv", "name,min,max\ntiny,1,2\n")
    write(one / "queue_names.csv", "queue_name\nq\n")
    write(one / "a_preprocessed.csv.gz", csv(HEADER, ROW), packed=True)
    write(one / "notes.txt", "no log\n")
    lower = [c.lower() for c in HEADER]
    write(two / "c.csv", csv(["extra", *reversed(lower)], ["9", *reversed(["j3", *ROW[1:]])]))
    rows = {r.job_name: r for r in joblog.scan_job_logs(spark, str(one), str(two)).collect()}
    assert {n: r.source_file for n, r in rows.items()} == {"j1": "a.csv", "j2": "b.csv.gz", "j3": "c.csv"}
    assert rows["j3"].used_core_hours == 3.5 and rows["j3"].queue_name == "q"
    assert rows["j2"].queued_timestamp is None and rows["j2"].walltime_seconds is None
    assert rows["j2"].start_timestamp.day == 5
    assert joblog.read_raw_log(spark, str(two / "c.csv")).first().nodes_used == 2


def test_scan_reads_every_layout_of_a_folder_and_fails_without_logs(spark, tmp_path):
    write(tmp_path / "a.csv", csv(HEADER, ROW))
    write(tmp_path / "b.csv", csv(["more", *reversed(HEADER)], ["0", *reversed(["j2", *ROW[1:]])]))
    write(tmp_path / "c.csv.gz", csv([c.lower() for c in HEADER], ["j3", *ROW[1:]]), packed=True)
    write(tmp_path / "max_nodes.csv", "max_nodes\n12\n")
    rows = {r.job_name: r for r in joblog.scan_job_logs(spark, str(tmp_path)).collect()}
    assert {n: r.source_file for n, r in rows.items()} == {"j1": "a.csv", "j2": "b.csv", "j3": "c.csv.gz"}
    assert {(r.queue_name, r.used_core_hours) for r in rows.values()} == {("q", 3.5)}
    write(tmp_path / "d.csv", csv(HEADER[1:], ROW[1:]))
    with pytest.raises(ValueError, match="job_name"):
        joblog.scan_job_logs(spark, str(tmp_path))
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        joblog.scan_job_logs(spark, str(empty))


def test_round_trips(spark, tmp_path, make_jobs):
    jobs = clean_jobs(
        make_jobs(
            [
                {"queued_timestamp": "2024-01-02 00:00:00.123456"},
                {"queued_timestamp": "2023-12-02 00:00:00", "queue_name": "a,b"},
                {"queued_timestamp": None, "start_timestamp": None},
            ]
        )
    )
    expected = sorted(map(str, jobs.collect()))
    sinks.write_clean_jobs(jobs, f"{tmp_path}/csv", "csv")
    back = joblog.read_clean_log(spark, f"{tmp_path}/csv", "csv")
    assert sorted(map(str, back.collect())) == expected and back.columns == jobs.columns
    written = [line for p in sorted(glob.glob(f"{tmp_path}/csv/*.csv.gz")) for line in gzip.open(p, "rt")]
    queued = [line.split(",")[0] for line in written if not line.startswith("job_name")]
    assert queued == ["j1", "j0", "j2"]
    sinks.write_clean_jobs(jobs, f"{tmp_path}/parquet")
    parts = joblog.read_clean_log(spark, f"{tmp_path}/parquet")
    assert sorted(map(str, parts.select(*jobs.columns).collect())) == expected
    assert os.path.isdir(f"{tmp_path}/parquet/start_year=2024/start_month=1")
    with pytest.raises(ValueError):
        sinks.write_clean_jobs(jobs, f"{tmp_path}/x", "orc")


def test_filtered_output_per_source_is_not_deduplicated(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", csv(HEADER, ROW, ROW, ["j9", *ROW[1:8], "99999", *ROW[9:]]))
    sinks.write_filtered_by_source(joblog.scan_job_logs(spark, str(folder)), f"{tmp_path}/out")
    back = spark.read.option("header", True).csv(f"{tmp_path}/out")
    assert [r.job_name for r in back.collect()] == ["j1", "j1"]
    assert os.path.isdir(f"{tmp_path}/out/source_file=a.csv")


def configure(folder):
    write(folder / "job_dimension.csv", "name,min,max\ntiny,1,10\nhuge,11,infinity\n")
    write(folder / "walltime.csv", "name,min,max\nshort,1,3600\nlong,3601,infinity\n")
    write(folder / "max_nodes.csv", "max_nodes\n12\n")


def test_machine_configuration(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="max_nodes"):
        machine.read_machine(spark, str(tmp_path))
    configure(tmp_path)
    found = machine.read_machine(spark, str(tmp_path))
    assert found.max_nodes == 12 and found.queues is None
    assert [b.label for b in found.size_bins] == ["1-10", "11-infinity"]
    with pytest.raises(FileNotFoundError, match="queue_names"):
        machine.read_machine(spark, str(tmp_path), with_queues=True)
    write(tmp_path / "queue_names.csv", "queue_name,min_nodes\nq,1\n,\nr,1\n")
    queues = machine.read_machine(spark, str(tmp_path), with_queues=True).queues
    assert sorted(r.queue_name for r in queues.collect()) == ["q", "r"]


@pytest.mark.parametrize("levels", [None, ("all", "year", "month")])
def test_whole_analysis_is_written(spark, tmp_path, make_jobs, levels):
    configure(tmp_path)
    write(tmp_path / "queue_names.csv", "queue_name\nq\n")
    config = machine.read_machine(spark, str(tmp_path), with_queues=True)
    jobs = clean_jobs(
        make_jobs(
            [
                {"start_timestamp": f"2024-0{1 + i % 3}-01 00:00:00", "end_timestamp": f"2024-0{1 + i % 3}-01 0{1 + i % 4}:00:00", "nodes_used": 5}
                for i in range(12)
            ]
        )
    )
    results = analyse(
        jobs, config, "Test", slices=levels, queue_analysis=True, full_queue_analysis=True, machine_utilization=True
    )
    sinks.write_results(results, f"{tmp_path}/out")
    assert sorted(os.listdir(tmp_path / "out")) == sorted(results)
    for name in results:
        table = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert table.columns and (table.count() > 0 or "core_hours_" in name)
    if levels:
        slices = {r[0] for r in spark.read.parquet(f"{tmp_path}/out/utilization_stats").select("slice").collect()}
        assert {str(s) for s in slices} == {"all", "2024", "2024-01", "2024-02", "2024-03"}


def test_text_reports(spark, tmp_path, make_jobs):
    rows = [{"start_timestamp": "2024-01-01 00:00:00", "end_timestamp": f"2024-01-01 0{i}:00:00", "nodes_used": 6} for i in (1, 2, 3)]
    jobs = make_jobs(rows)
    nodes = u.nodes_in_use(jobs)
    stats = report.utilization_lines(u.utilization_stats(nodes, 12)).orderBy("line_no")
    assert [r.line for r in stats.collect()][:3] == [
        "Max nodes available: 12",
        "Max utilization: 18 nodes (150.00 %)",
        "Min utilization: 0 nodes (0.00 %)",
    ]
    intervals = capacity.over_capacity_intervals(nodes, 12)
    lines = report.over_capacity_lines(intervals, capacity.over_capacity_jobs(jobs, intervals))
    sinks.write_lines(lines, f"{tmp_path}/report", ["interval_no", "section", "job_name", "line_no"])
    text = [line.rstrip("\n") for p in sorted(glob.glob(f"{tmp_path}/report/part*")) for line in open(p)]
    assert text == [
        "=" * 80,
        "Over-capacity interval 1",
        "Start: 2024-01-01 00:00:00",
        "End  : 2024-01-01 01:00:00",
        "Duration: 60.00 min",
        "Max nodes used: 18",
        "",
        "Jobs running at START:",
        "  - j0: 6 nodes (start: 2024-01-01 00:00:00, end: 2024-01-01 01:00:00)",
        "  - j1: 6 nodes (start: 2024-01-01 00:00:00, end: 2024-01-01 02:00:00)",
        "  - j2: 6 nodes (start: 2024-01-01 00:00:00, end: 2024-01-01 03:00:00)",
        "",
        "Jobs running at END:",
        "  - j1: 6 nodes (start: 2024-01-01 00:00:00, end: 2024-01-01 02:00:00)",
        "  - j2: 6 nodes (start: 2024-01-01 00:00:00, end: 2024-01-01 03:00:00)",
        "",
    ]


class Counting:
    """A file that tells how much of it was read."""

    def __init__(self, content):
        self.content, self.at = content, 0

    def read(self, size):
        part = self.content[self.at : self.at + size]
        self.at += len(part)
        return part


@pytest.mark.parametrize("rows", [1, 1000, 1_000_000])
def test_first_lines_cost_the_same_for_files_of_any_length(rows):
    stream = Counting(b"JOB_NAME,QUEUE_NAME\n" + b"a,b\n" * rows)
    assert headers.first_line(stream) == "JOB_NAME,QUEUE_NAME"
    assert stream.at <= headers.PIECE


def test_first_lines_of_odd_files():
    long = b"c" * (3 * headers.PIECE)
    for content, line in ((b"", None), (b"\n", ""), (b"a,b", "a,b"), (b"a,b\r\nx", "a,b"), (b"a,b\rx", "a,b"), (long + b"\nx", long.decode()), ("ä,ß\n".encode(), "ä,ß")):
        assert headers.first_line(Counting(content)) == line


def test_files_that_only_spark_opens_are_scanned(spark, tmp_path, monkeypatch):
    for name, columns in (("a.csv", list(RAW_TYPES)), ("b b.csv", list(reversed(RAW_TYPES)))):
        write(tmp_path / name, ",".join(columns) + "\n" + ",".join("1" if c == "nodes_used" else "" for c in columns) + "\n")
    write(tmp_path / "empty.csv", "")
    opened = sorted(map(sorted, joblog._layouts(spark, str(tmp_path))))
    unknown = lambda *args: headers.first_lines(*args).withColumns({"header": F.lit(None).cast("string"), "opened": F.lit(False)})
    monkeypatch.setattr(joblog, "first_lines", unknown)
    scanned = joblog._layouts(spark, str(tmp_path))
    assert len(opened) == len(scanned) == 2
    assert {len(group) for group in scanned} == {1}
    assert joblog.scan_job_logs(spark, str(tmp_path)).agg(F.sum("nodes_used")).first()[0] == 2


def test_each_source_file_is_written_on_its_own(spark, tmp_path, make_jobs):
    rows = [{"job_name": f"j{i // 2}", "runtime_seconds": 1.0 if i % 3 else 99_999.0, "nodes_used": i} for i in range(12)]
    raw = make_jobs(rows).withColumn("source_file", F.concat(F.lit("f"), F.col("nodes_used") % 2, F.lit(".csv"))).unionByName(
        make_jobs([{"runtime_seconds": -1.0}]).withColumn("source_file", F.lit("none kept.csv"))
    )
    sinks.write_filtered_by_source(raw, f"{tmp_path}/out")
    written = joblog.read_filtered_by_source(spark, f"{tmp_path}/out")
    audit = {r.source_file: r for r in sinks.file_audit(raw, written).collect()}
    # copies of a job stay, in their own file
    assert {f: (r.rows_read, r.rows_written, r.nodes_used) for f, r in audit.items()} == {
        "f0.csv": (6, 4, 2 + 4 + 8 + 10), "f1.csv": (6, 4, 1 + 5 + 7 + 11), "none kept.csv": (1, 0, None)
    }
