"""Cleaning of raw job logs: parsing, derived columns, filters, deduplication, audit."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from nodeledger.functions.times import seconds_between
from nodeledger.schema import (
    CLEAN_COLUMNS,
    DEDUP_ORDER,
    MAX_RUNTIME_RATIO,
    RAW_TYPES,
    SUCCESS_EXIT_CODES,
    TIMESTAMP_COLUMNS,
    require_columns,
)


# Texts that stand for a missing value, and the range of times with nanoseconds in 64 bits.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
FIRST_TIME, LAST_TIME = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, keep the known columns in order and give them their types.

    A value that cannot be read as its type becomes null.
    """
    lowered = df.toDF(*[c.strip().lower() for c in df.columns])
    require_columns(lowered, *RAW_TYPES)
    return lowered.select(*typed_columns(lowered, RAW_TYPES))


def typed_columns(df: DataFrame, types: dict[str, str]) -> list[Column]:
    """The named columns with the given types; what cannot be converted becomes null.

    Whole numbers may be written with a decimal point, as a column with missing values often is.
    Texts that stand for a missing value become null, and so does a double that is not a number.
    """
    present = dict(df.dtypes)

    def converted(name: str, wanted: str) -> Column:
        value = F.col(name)
        if present[name] == "string":
            value = F.when(~value.isin(*MISSING_TEXTS), value)
        elif present[name] in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        if present[name] == wanted:
            return value.alias(name)
        if present[name] == "string" and wanted in ("bigint", "int"):
            value = value.try_cast("double")
        value = value.try_cast(wanted)
        if present[name] == "string" and wanted == "double":
            value = F.when(~F.isnan(value), value)
        return value.alias(name)

    return [converted(c, t) for c, t in types.items()]


def parse_timestamps(df: DataFrame, columns: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """Turn text times into timestamps; unreadable text and times out of range become null."""
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (FIRST_TIME, LAST_TIME))

    def parsed(name: str) -> Column:
        time = F.col(name).try_cast("timestamp_ntz")
        return F.when(time.between(first, last), time)

    return df.withColumns({c: parsed(c) for c in columns if c in df.columns})


def _not_negative(value: Column) -> Column:
    return F.when(value >= 0, value)


def derive_wait(df: DataFrame) -> DataFrame:
    """Add ``wait_seconds``; a negative wait is an anomaly and becomes null."""
    wait = seconds_between("queued_timestamp", "start_timestamp")
    return df.withColumn("wait_seconds", _not_negative(wait))


def runtime_check(df: DataFrame) -> DataFrame:
    """Add the runtime implied by the timestamps, null when negative."""
    implied = seconds_between("start_timestamp", "end_timestamp")
    return df.withColumn("runtime_seconds_check", _not_negative(implied))


def select_clean_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in CLEAN_COLUMNS if c in df.columns])


def _rules() -> dict[str, Column]:
    runtime, walltime = F.col("runtime_seconds"), F.col("walltime_seconds")
    return {
        "runtime_within_limit": runtime < MAX_RUNTIME_RATIO * walltime,
        "non_negative_times": (runtime >= 0) & (walltime >= 0),
        "non_negative_core_hours": F.col("used_core_hours") >= 0,
    }


def clean_filters(df: DataFrame) -> DataFrame:
    """Keep the rows that pass every cleaning rule; a missing value fails its rule."""
    for rule in _rules().values():
        df = df.filter(rule)
    return df


def dedup_jobs(df: DataFrame) -> DataFrame:
    """Keep one row per job name, the first in :data:`DEDUP_ORDER`; null names count as equal.

    Filtering a row number on its first value lets Spark keep one row per name and task before the
    shuffle, so a name that holds a large part of the log does not land in one task.
    """
    order = [F.col(c).asc_nulls_last() for c in DEDUP_ORDER if c in df.columns]
    first = Window.partitionBy("job_name").orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")


def clean_jobs(raw: DataFrame) -> DataFrame:
    """The whole cleaning stage: raw log in, cleaned and deduplicated log out."""
    typed = derive_wait(normalize_columns(raw))
    return dedup_jobs(clean_filters(select_clean_columns(typed)))


def _audit_rows(counts: dict[str, Column]) -> Column:
    """The audit's rows from the number of rows read and left after each step, in order."""
    chain = list(counts)
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(after).alias("rule"),
            counts[before].alias("rows_before"),
            counts[after].alias("rows_after"),
            (counts[before] - counts[after]).alias("rows_dropped"),
        )
        for i, (before, after) in enumerate(zip(chain, chain[1:]), start=1)
    ]
    return F.inline(F.array(*rows))


def _passed() -> dict[str, Column]:
    """For each rule, whether a row passes it and those before."""
    passed, out = F.lit(True), {}
    for name, rule in _rules().items():
        passed = passed & rule
        out[name] = passed
    return out


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """Rows before and after each rule and the deduplication, one row per step.

    The rules are counted in one pass, as each job name's counts; adding those up also gives the
    number of distinct names.
    """
    steps = _passed()
    counts = [F.count_if(passed).alias(name) for name, passed in steps.items()]
    per_name = normalize_columns(raw).groupBy("job_name").agg(F.count(F.lit(1)).alias("_read"), *counts)
    totals = per_name.agg(
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in ("_read", *steps)],
        F.count_if(F.col(list(steps)[-1]) > 0).alias("unique_job_name"),
    )
    return totals.select(_audit_rows({s: F.col(s) for s in ("_read", *steps, "unique_job_name")}))


def _observed(metrics: Observation) -> dict[str, int]:
    """What was counted; nothing where an empty log let Spark skip the counting step."""
    try:
        return metrics.get
    except Py4JJavaError:
        return {}


class AuditedCleaning:
    """The cleaning stage with its audit, counted by the tasks that clean.

    ``jobs`` is the cleaned log. After its first action, writing it for example, ``audit()`` is
    what :func:`cleaning_audit` computes by a pass of its own. Counts are of the rows the action
    went through: a task repeated because its shuffle files were lost counts again, so after
    lost executors the numbers are upper bounds; :func:`cleaning_audit` is exact always.
    """

    def __init__(self, raw: DataFrame):
        self._spark = raw.sparkSession
        self._read, self._kept = Observation(), Observation()
        counts = [F.count_if(passed).alias(name) for name, passed in _passed().items()]
        typed = normalize_columns(raw).observe(self._read, F.count(F.lit(1)).alias("_read"), *counts)
        cleaned = dedup_jobs(clean_filters(select_clean_columns(derive_wait(typed))))
        self.jobs = cleaned.observe(self._kept, F.count(F.lit(1)).alias("unique_job_name"))

    def audit(self) -> DataFrame:
        """The audit as a table; waits for the action on ``jobs``."""
        order = ("_read", *_rules(), "unique_job_name")
        found = _observed(self._read) | _observed(self._kept)
        found = {n: found.get(n, 0) for n in order}
        counts = {n: F.lit(v).cast("bigint") for n, v in found.items()}
        return self._spark.range(1).select(_audit_rows({n: counts[n] for n in order}))


def successful_jobs(df: DataFrame) -> DataFrame:
    """Jobs whose exit code counts as success."""
    require_columns(df, "exit_code")
    return df.filter(F.col("exit_code").isin(*SUCCESS_EXIT_CODES))


def _require_some(queues: DataFrame | Sequence[str] | None) -> None:
    if queues is None or (not isinstance(queues, DataFrame) and not queues):
        raise ValueError("a list of valid queues is required")


def _marked(df: DataFrame, queues: DataFrame | Sequence[str] | None) -> DataFrame:
    """``df`` with ``_valid``: whether the job's queue is configured."""
    _require_some(queues)
    if isinstance(queues, DataFrame):
        names = queues.select(F.col("queue_name"), F.lit(True).alias("_valid")).dropna().distinct()
        return df.join(names, "queue_name", "left").withColumn("_valid", F.coalesce("_valid", F.lit(False)))
    listed = F.col("queue_name").isin(*[q for q in queues if q is not None])
    return df.withColumn("_valid", F.coalesce(listed, F.lit(False)))


def valid_queue_jobs(df: DataFrame, queues: DataFrame | Sequence[str] | None) -> DataFrame:
    """Jobs of the configured queues: a table ``queues(queue_name)``, or a few names written out.

    A table of any length is a semi-join; names are literals of a filter that reaches the scan.
    """
    if isinstance(queues, DataFrame):
        return df.join(queues.select("queue_name"), "queue_name", "left_semi").select(*df.columns)
    _require_some(queues)
    # as it stands, without a coalesce around it, which a scan could not use
    return df.filter(F.col("queue_name").isin(*[q for q in queues if q is not None]))


def dropped_queue_jobs(df: DataFrame, queues: DataFrame | Sequence[str] | None) -> DataFrame:
    """Number of jobs kept and dropped by :func:`valid_queue_jobs`."""
    per_queue = df.groupBy("queue_name").agg(F.count("*").alias("_jobs"))
    jobs = lambda of: F.coalesce(F.sum(F.when(of, F.col("_jobs"))), F.lit(0))
    return _marked(per_queue, queues).agg(
        jobs(F.lit(True)).alias("rows_before"),
        jobs(F.col("_valid")).alias("rows_kept"),
        jobs(~F.col("_valid")).alias("rows_dropped"),
    )
