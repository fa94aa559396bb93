"""Joining moments with the spans that hold them, without pairs that don't match.

Time is cut into units, and units into a binary hierarchy of nodes: node ``n`` of level ``l`` is the
units from ``n * 2**l`` up to the next multiple. A span is covered by two nodes per level at most,
and a moment lies in one node of every level, so both sides meet in an equi-join on the node.
A span of two centuries is some forty rows, one of a few hours three or four.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.functions.times import time_bucket

UNIT_SECONDS = 3600
#: Levels of nodes: 2**24 hours are nineteen centuries, more than a timestamp of the log may span.
LEVELS = 24
#: Moments of a unit that travel together: some 40 kB.
MOMENTS_TOGETHER = 1000

LEVEL, NODE = "_level", "_node"


def covering_nodes(first: str, last: str) -> Column:
    """Array of (level, node): the fewest nodes that cover the units from ``first`` to ``last``."""
    # at level l, whole nodes lie from ceil(first / 2**l) up to floor((last + 1) / 2**l); one that has
    # no whole parent in there is taken: an odd first one, and the one before an odd end
    low = f"shiftright({first} + shiftleft(1L, l) - 1, l)"
    end = f"shiftright({last} + 1, l)"
    pick = "named_struct('{level}', l, '{node}', {at}, 'taken', {low} < {end} and ({odd} & 1) = 1)".format
    left = pick(level=LEVEL, node=NODE, at=low, low=low, end=end, odd=low)
    right = pick(level=LEVEL, node=NODE, at=f"{end} - 1", low=low, end=end, odd=end)
    deep = f"least({LEVELS - 1}, cast(log2({last} - {first} + 1) as int) + 1)"
    nodes = f"flatten(transform(sequence(0, {deep}), l -> array({left}, {right})))"
    return F.expr(f"transform(filter({nodes}, x -> x.taken), x -> named_struct('{LEVEL}', x.{LEVEL}, '{NODE}', x.{NODE}))")


def enclosing_nodes(unit: str) -> Column:
    """Array of (level, node): the node of every level that holds a unit."""
    return F.expr(f"transform(sequence(0, {LEVELS - 1}), l -> named_struct('{LEVEL}', l, '{NODE}', shiftright({unit}, l)))")


def with_nodes(spans: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each covering node of each span; ``end`` is after ``start``, both not null."""
    units = spans.withColumns({"_first": time_bucket(start, UNIT_SECONDS), "_last": time_bucket(end, UNIT_SECONDS)})
    return units.select(*spans.columns, F.inline(covering_nodes("_first", "_last")))


def packed_moments(moments: DataFrame, at: str, keys: Sequence[str]) -> DataFrame:
    """(keys, level, node, _moments): the moments of a unit in arrays, under each node that holds it."""
    rest = [c for c in moments.columns if c not in keys]
    in_units = moments.withColumn("_unit", time_bucket(at, UNIT_SECONDS))
    # a unit may hold many moments, so arrays are numbered within it
    nth = F.row_number().over(Window.partitionBy(*keys, "_unit").orderBy(*rest))
    packs = (
        in_units.withColumn("_pack", F.floor((nth - 1) / MOMENTS_TOGETHER))
        .groupBy(*keys, "_unit", "_pack")
        .agg(F.collect_list(F.struct(*rest)).alias("_moments"))
    )
    return packs.select(*keys, "_moments", F.inline(enclosing_nodes("_unit")))


def moments_in_spans(nodes: DataFrame, packs: DataFrame, at: str, start: str, end: str, keys: Sequence[str]) -> DataFrame:
    """Each row of ``nodes`` with each moment ``at`` that lies from ``start`` up to ``end``, once."""
    spans = [c for c in nodes.columns if c not in (*keys, LEVEL, NODE)]

    def inside(moment: Column) -> Column:
        return (moment[at] >= F.col(start)) & (moment[at] < F.col(end))

    met = nodes.join(packs, [*keys, LEVEL, NODE])
    return met.select(*keys, *spans, F.inline(F.filter("_moments", inside)))
