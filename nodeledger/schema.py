"""Column names, types and fixed values of the job-log data model."""

from __future__ import annotations

# The columns of a raw scheduler export, in lower case.
RAW_TYPES = {
    "job_name": "string",
    "username_genid": "string",
    "project_name_genid": "string",
    "queue_name": "string",
    "queued_timestamp": "timestamp_ntz",
    "start_timestamp": "timestamp_ntz",
    "end_timestamp": "timestamp_ntz",
    "walltime_seconds": "double",
    "runtime_seconds": "double",
    "nodes_requested": "bigint",
    "nodes_used": "bigint",
    "used_core_hours": "double",
    "exit_code": "int",
}

TIMESTAMP_COLUMNS = ("queued_timestamp", "start_timestamp", "end_timestamp")

# The columns of a cleaned job log, in output order.
CLEAN_COLUMNS = (
    "job_name",
    "username_genid",
    "project_name_genid",
    "queue_name",
    "queued_timestamp",
    "wait_seconds",
    "start_timestamp",
    "end_timestamp",
    "walltime_seconds",
    "runtime_seconds",
    "nodes_requested",
    "nodes_used",
    "used_core_hours",
    "exit_code",
)

# Which of several copies of a job is kept: the first in this order, nulls last.
DEDUP_ORDER = (
    "queued_timestamp",
    "start_timestamp",
    "end_timestamp",
    "walltime_seconds",
    "runtime_seconds",
    "username_genid",
    "queue_name",
    "project_name_genid",
    "nodes_requested",
    "nodes_used",
    "used_core_hours",
    "exit_code",
)

# Fixed values of the cleaning rules and reports.
MAX_RUNTIME_RATIO = 1.5
SUCCESS_EXIT_CODES = (0, -29)
MIN_OVER_CAPACITY_SECONDS = 60
GRID_MINUTES = 15
MIN_SCATTER_WALLTIME = 100
MARKER_MIN, MARKER_MAX = 5, 500
TOP_QUEUES = 10
AREA_SHARE_PERCENT = 3.0
PIE_SHARE_PERCENT = 1.0
TREND_FRACTION = 0.01
TREND_ROBUST_PASSES = 3

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Metrics of the per-queue report, in report order, with their labels.
REPORT_METRICS = {
    "nodes_used": "Nodes Used",
    "nodes_requested": "Nodes Requested",
    "walltime_seconds": "Walltime",
    "runtime_seconds": "Runtime",
    "wait_seconds": "Wait Time",
    "used_core_hours": "Core-Hours per Job",
}
DURATION_METRICS = ("walltime_seconds", "runtime_seconds", "wait_seconds")


def require_columns(df, *names: str) -> None:
    """Fail while the plan is built, before any job runs, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
