"""Small numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nodeledger.schema import MARKER_MAX, MARKER_MIN


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def marker_size(nodes: Column, capacity: int) -> Column:
    """Marker area: the smallest for one node, the largest for the whole machine."""
    if capacity <= 1:
        return F.lit(float(MARKER_MIN))
    return F.lit(float(MARKER_MIN)) + (nodes - 1) / F.lit(float(capacity - 1)) * (
        MARKER_MAX - MARKER_MIN
    )
