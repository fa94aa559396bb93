"""Zero-filled grids: every row key crossed with every value of one short axis.

The counts of a row key are packed into one map and the axis is unpacked from it again, so that
filling needs no join and no list of all pairs beyond the result itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeledger.plans.attach import attach

CELLS, AXIS = "_cells", "_axis"


def densify(
    df: DataFrame,
    rows: Sequence[str],
    axis: str,
    value: str,
    axis_values: Column | None = None,
    within: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """One row per (``rows``, axis value), with 0 where ``df`` has none.

    ``df`` holds at most one row per (``rows``, ``axis``); a null ``axis`` keeps its row key alive
    but fills no cell. The axis is ``axis_values`` or, when that is not given, the values present
    within ``within`` (a subset of ``rows``), which must be few: bins, weekdays, queues. ``total``
    names a column for the sum over the row key's cells.
    """
    filled = F.col(axis).isNotNull()
    packed = df.groupBy(*rows).agg(
        F.map_from_entries(F.collect_list(F.when(filled, F.struct(axis, value)))).alias(CELLS),
        F.coalesce(F.sum(F.when(filled, F.col(value))), F.lit(0)).alias(total or "_total"),
    )
    if axis_values is None:
        present = packed.select(*within, F.explode(F.map_keys(CELLS)).alias(axis))
        values = present.groupBy(*within).agg(F.array_sort(F.collect_set(axis)).alias(AXIS))
        packed = attach(packed, values, within)
    else:
        packed = packed.withColumn(AXIS, axis_values)
    kept_total = [total] if total else []
    unpacked = packed.select(*rows, CELLS, *kept_total, F.explode(AXIS).alias(axis))
    cell = F.coalesce(F.try_element_at(CELLS, F.col(axis)), F.lit(0)).alias(value)
    return unpacked.select(*rows, axis, cell, *kept_total)
