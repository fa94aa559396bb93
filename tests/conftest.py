import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nodeledger.schema import RAW_TYPES  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("nodeledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # A zone with clock changes: results must not depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text):
    return None if text is None else datetime.fromisoformat(text)


DEFAULTS = {
    "job_name": "j",
    "username_genid": "u",
    "project_name_genid": "p",
    "queue_name": "q",
    "queued_timestamp": "2024-01-01 00:00:00",
    "start_timestamp": "2024-01-01 01:00:00",
    "end_timestamp": "2024-01-01 02:00:00",
    "walltime_seconds": 7200.0,
    "runtime_seconds": 3600.0,
    "nodes_requested": 1,
    "nodes_used": 1,
    "used_core_hours": 1.0,
    "exit_code": 0,
}


@pytest.fixture(scope="session")
def make_jobs(spark):
    """A raw log from dictionaries that name only what matters; job names count up."""

    def make(rows):
        filled = []
        for i, row in enumerate(rows):
            values = DEFAULTS | {"job_name": f"j{i}"} | row
            for c in ("queued_timestamp", "start_timestamp", "end_timestamp"):
                values[c] = moment(values[c])
            filled.append(tuple(values[c] for c in RAW_TYPES))
        schema = ", ".join(f"{c} {t}" for c, t in RAW_TYPES.items())
        return spark.createDataFrame(filled, schema)

    return make
