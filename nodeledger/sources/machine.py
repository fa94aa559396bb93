"""Machine configuration: bins, capacity and the list of valid queues.

Bins and capacity become plan literals, so that binning is a projection: every bin is a row or a
column of the results. The queue list stays a table, whatever its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Seconds of the units of short labels.
UNITS = {"h": 3600, "m": 60, "s": 1}


def _short(seconds: float) -> str:
    """Whole number of the largest unit that fits."""
    unit = next((u for u, size in UNITS.items() if size <= seconds), "s")
    return f"{math.floor(seconds / UNITS[unit])}{unit}"


@dataclass(frozen=True)
class Bin:
    """An inclusive range ``[lo, hi]``; ``hi`` may be infinite."""

    name: str
    lo: float
    hi: float

    @property
    def label(self) -> str:
        top = "infinity" if math.isinf(self.hi) else f"{self.hi:g}" if self.hi % 1 else f"{int(self.hi)}"
        low = f"{self.lo:g}" if self.lo % 1 else f"{int(self.lo)}"
        return f"{low}-{top}"

    @property
    def duration_label(self) -> str:
        ends = [_short(b) for b in (self.lo, self.hi) if b < math.inf]
        return "–".join(ends) if len(ends) == 2 else ">" + ends[0]


@dataclass(frozen=True)
class Machine:
    """``max_nodes`` of 0 means: use the largest job of the data as the capacity."""

    size_bins: tuple[Bin, ...]
    walltime_bins: tuple[Bin, ...]
    max_nodes: int = 0
    queues: DataFrame | tuple[str, ...] | None = None


def _read_config(spark: SparkSession, directory: str, name: str) -> DataFrame:
    try:
        df = spark.read.option("header", True).csv(f"{directory}/{name}")
    except AnalysisException as error:
        raise FileNotFoundError(f"missing {name} in {directory}") from error
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_bins(spark: SparkSession, directory: str, name: str) -> tuple[Bin, ...]:
    df = _read_config(spark, directory, name)
    bounds = df.select("name", F.col("min").cast("double"), F.col("max").cast("double"))
    return tuple(Bin(r[0], r[1], r[2]) for r in bounds.collect())


def read_machine(spark: SparkSession, directory: str, with_queues: bool = False) -> Machine:
    """Read ``job_dimension.csv``, ``walltime.csv``, ``max_nodes.csv`` and, on request,
    ``queue_names.csv`` of a machine directory. The queues are a table with one column."""
    capacity = _read_config(spark, directory, "max_nodes.csv").select("max_nodes").first()
    queues = None
    if with_queues:
        queues = _read_config(spark, directory, "queue_names.csv").select("queue_name").dropna().distinct()
    return Machine(
        size_bins=read_bins(spark, directory, "job_dimension.csv"),
        walltime_bins=read_bins(spark, directory, "walltime.csv"),
        max_nodes=int(capacity[0]),
        queues=queues,
    )
