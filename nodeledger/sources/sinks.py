"""Writing cleaned logs, result tables and text reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.operators.clean import clean_filters, derive_wait, select_clean_columns

_CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _csv(df: DataFrame, mode: str):
    writer = df.write.mode(mode).option("header", True).option("compression", "gzip")
    return writer.option("timestampNTZFormat", _CSV_TIME)


def write_clean_jobs(
    jobs: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Write a cleaned log.

    ``csv``: gzip files that follow each other in queue time; the job name as second sort key
    spreads a crowded instant over several files. ``parquet``: folders by start year and month, so
    that a slice reads only its own; rebalancing splits a crowded month over several files.
    """
    if file_format == "csv":
        order = [F.col("queued_timestamp").asc_nulls_last(), F.col("job_name").asc_nulls_last()]
        _csv(jobs.orderBy(*order), mode).csv(path)
    elif file_format == "parquet":
        start = F.col("start_timestamp")
        dated = jobs.withColumns({"start_year": F.year(start), "start_month": F.month(start)})
        placed = dated.hint("rebalance", "start_year", "start_month")
        placed.write.mode(mode).partitionBy("start_year", "start_month").parquet(path)
    else:
        raise ValueError(f"unknown format {file_format!r}")


def write_filtered_by_source(raw: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the filtered but not deduplicated jobs of each source file to a folder of its own."""
    filtered = clean_filters(derive_wait(raw))
    kept = select_clean_columns(filtered).columns
    placed = filtered.select(*kept, "source_file").hint("rebalance", "source_file")
    _csv(placed, mode).partitionBy("source_file").csv(path)


def file_audit(raw: DataFrame, written: DataFrame) -> DataFrame:
    """For each source file: rows read, rows written by :func:`write_filtered_by_source`, and what those hold.

    ``written`` is what was read back, so a lost, doubled or misplaced row shows. Files of which no row
    was kept have no folder and 0 rows written.
    """
    read = raw.groupBy("source_file").agg(F.count("*").alias("rows_read"))
    held = written.groupBy("source_file").agg(
        F.count("*").alias("_rows"),
        F.count_distinct("job_name").alias("_names"),
        F.sum("nodes_used").alias("nodes_used"),
        F.sum("runtime_seconds").alias("runtime_seconds"),
        F.min("queued_timestamp").alias("first_queued"),
        F.max("end_timestamp").alias("last_end"),
    )
    return read.join(held, "source_file", "left").select(
        "source_file",
        "rows_read",
        F.coalesce("_rows", F.lit(0)).alias("rows_written"),
        F.coalesce("_names", F.lit(0)).alias("job_names"),
        "nodes_used",
        "runtime_seconds",
        "first_queued",
        "last_end",
    )


def write_lines(
    lines: DataFrame, path: str, order: Sequence[str], mode: str = "errorifexists"
) -> None:
    """Write a table of lines as text files that follow each other in the given order."""
    lines.orderBy(*order).select("line").write.mode(mode).text(path)


def write_results(
    results: dict[str, DataFrame], path: str, mode: str = "errorifexists"
) -> None:
    """Write each result table as Parquet; a sliced table gets one folder per slice."""
    for name, table in results.items():
        writer = table.write.mode(mode)
        if "slice" in table.columns:
            writer = writer.partitionBy("slice")
        writer.parquet(f"{path}/{name}")
