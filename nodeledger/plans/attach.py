"""Adding summary columns (a mean, an axis, a capacity) to the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``summary``, which has one row per key, to ``df``.

    Both are aggregates. The adaptive planner broadcasts the summary where its measured size allows
    that, and splits a slice that holds most rows otherwise. Without keys the summary is a single
    row and becomes a scalar subquery.
    """
    added = [c for c in summary.columns if c not in keys]
    if keys:
        return df.join(summary, list(keys))
    packed = summary.select(F.struct(*added).alias("_summary")).scalar()
    return df.withColumn("_summary", packed).select(*df.columns, *[F.col(f"_summary.{c}") for c in added])
