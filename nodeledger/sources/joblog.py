"""Reading raw and cleaned job logs."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeledger.operators.clean import normalize_columns, typed_columns
from nodeledger.sources.headers import first_lines, first_lines_by_scan
from nodeledger.schema import CLEAN_COLUMNS, RAW_TYPES, require_columns

# A file whose name holds one of these is not a raw job log.
NOT_A_LOG = ("preprocessed", "job_dimension", "walltime", "queue", "max_nodes")
LOG_FILES = "*.{csv,csv.gz}"


def _is_log(file_name: Column) -> Column:
    return ~reduce(lambda a, b: a | b, [F.contains(file_name, F.lit(word)) for word in NOT_A_LOG])


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """One raw log file or folder of files, plain or gzip, with column names in any case."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return normalize_columns(raw)


def scan_job_logs(spark: SparkSession, *folders: str) -> DataFrame:
    """All raw logs in the given folders; configuration and already cleaned files are skipped.

    Files may differ in the order of their columns and in additional ones; columns are taken by name.
    A file without one of the columns is an error.
    ``source_file`` is the name of the file a row is from.
    """
    return reduce(DataFrame.unionByName, [_scan_folder(spark, f) for f in folders])


def _layouts(spark: SparkSession, folder: str) -> list[list[str]]:
    """The log files of a folder, grouped by their first line.

    Only the first lines are read. What comes back are paths, which Spark lists to plan a scan
    anyway. Empty files are left out.
    """
    files = first_lines(spark, folder, LOG_FILES, _is_log)
    groups = files.filter("not opened or header is not null").groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    closed = [r.paths for r in groups if r.header is None]
    found = {r.header: r.paths for r in groups if r.header is not None}
    if closed:
        scanned = first_lines_by_scan(spark, closed[0])
        for r in scanned.groupBy("header").agg(F.collect_list("path").alias("paths")).collect():
            # a scan names files as URIs
            found[r.header] = found.get(r.header, []) + [unquote(p) for p in r.paths]
    return list(found.values())


def _scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    layouts = _layouts(spark, folder)
    if not layouts:
        raise FileNotFoundError(f"no job log in {folder}")
    return reduce(DataFrame.unionByName, [_scan_layout(spark, paths) for paths in layouts])


def _scan_layout(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with one header between them; a file with another one stops the reading."""
    names = spark.read.option("header", True).csv(paths[0]).columns
    raw = (
        spark.read.schema(", ".join(f"`{c}` string" for c in names))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(paths)
        .select("*", F.col("_metadata.file_name").alias("source_file"))
    )
    lowered = raw.toDF(*[c.strip().lower() for c in raw.columns])
    require_columns(lowered, *RAW_TYPES)
    return lowered.select(*typed_columns(lowered, RAW_TYPES), "source_file")


_CLEAN_TYPES = {c: RAW_TYPES.get(c, "double") for c in CLEAN_COLUMNS}


def read_clean_log(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A cleaned log as written by :mod:`nodeledger.sources.sinks`."""
    if file_format == "parquet":
        return spark.read.parquet(path)
    if file_format != "csv":
        raise ValueError(f"unknown format {file_format!r}")
    schema = ", ".join(f"{c} string" for c in _CLEAN_TYPES)
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*typed_columns(rows, _CLEAN_TYPES))


def read_filtered_by_source(spark: SparkSession, path: str) -> DataFrame:
    """The folders written by :func:`sinks.write_filtered_by_source`, with ``source_file``."""
    schema = ", ".join(f"{c} string" for c in (*_CLEAN_TYPES, "source_file"))
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*typed_columns(rows, _CLEAN_TYPES), "source_file")
