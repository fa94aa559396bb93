"""Job logs derived from the given tables, so that every query has jobs to work on.

The main log joins order lines with their orders and parts: a line is a job, its part's brand the
queue, its ship date the start. The short log is the event stream of one month. Both joins are on
keys that grow with the data and are left to the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeledger.operators.clean import clean_jobs
from nodeledger.schema import RAW_TYPES
from nodeledger.sources.machine import Bin, Machine

INF = float("inf")

# The bins of the first machine and a capacity that its test log exceeds.
SIZE_BINS = (
    Bin("tiny", 1, 10),
    Bin("small", 11, 24),
    Bin("medium", 25, 99),
    Bin("large", 100, 496),
)
WALLTIME_BINS = (
    Bin("shortest", 1, 60),
    Bin("short", 61, 600),
    Bin("medium-short", 601, 1800),
    Bin("medium", 1801, 3600),
    Bin("medium-long", 3601, 7200),
    Bin("long", 7201, 21600),
    Bin("very-long", 21601, 43200),
    Bin("super-extreme", 43201, 64800),
    Bin("ultra", 64801, 86400),
    Bin("mega", 86401, 259200),
    Bin("extra-infinity", 259201, INF),
)
# All brands but the seventh and the nineteenth are valid queues.
QUEUES = tuple(f"Brand#{i}" for i in range(1, 26) if i not in (7, 19))
MACHINE = Machine(SIZE_BINS, WALLTIME_BINS, max_nodes=400, queues=QUEUES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main raw log, with the columns and types of a scheduler export."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    second = F.expr("INTERVAL '1' SECOND")
    offset = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 3571) % 86400
    start = F.col("l_shipdate") + second * offset
    runtime = F.floor("l_extendedprice")
    columns = {
        "job_name": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "username_genid": F.col("l_suppkey"),
        "project_name_genid": F.col("l_suppkey") % 25,
        "queue_name": F.col("p_brand"),
        "queued_timestamp": F.col("o_orderdate"),
        "start_timestamp": start,
        "end_timestamp": start + second * runtime,
        "walltime_seconds": F.col("l_quantity") * 1800,
        "runtime_seconds": runtime,
        "nodes_requested": F.col("l_quantity"),
        "nodes_used": F.col("p_size"),
        "used_core_hours": F.col("p_size") * runtime / 3600.0,
        "exit_code": F.when(F.col("l_returnflag") == "N", 0)
        .when(F.col("l_returnflag") == "A", -29)
        .otherwise(1),
    }
    return joined.select(*[c.cast(RAW_TYPES[n]).alias(n) for n, c in columns.items()])


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main log, cleaned."""
    return clean_jobs(raw_jobs(spark, sf_dir))


def event_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short log: one month, already clean, with fractions of a second."""
    runtime = F.floor(F.col("value") * 60)
    start = F.col("ts")
    nodes = F.col("event_id") % 40 + 1
    columns = {
        "job_name": F.col("event_id"),
        "username_genid": F.col("user_id"),
        "project_name_genid": F.col("user_id") % 25,
        "queue_name": F.col("event_type"),
        "queued_timestamp": start,
        "start_timestamp": start,
        "end_timestamp": start + F.expr("INTERVAL '1' SECOND") * runtime,
        "walltime_seconds": runtime * 2,
        "runtime_seconds": runtime,
        "nodes_requested": nodes,
        "nodes_used": nodes,
        "used_core_hours": nodes * runtime / 3600.0,
        "exit_code": F.lit(0),
    }
    events = _table(spark, sf_dir, "events")
    return events.select(*[c.cast(RAW_TYPES[n]).alias(n) for n, c in columns.items()])
