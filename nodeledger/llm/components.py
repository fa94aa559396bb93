"""Connected components of a link table by repeated local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.store import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links(src, dst)``: the smallest id it can reach.

    In each round every id moves to the neighbour, or itself, that comes first in an order of that
    round, and links are rewritten between the places moved to. The first round goes by id, which
    ends stars around a smallest id at once. Later orders are random: a constant share of the ids
    disappears per round whatever the shape of the graph, so long chains take logarithmically
    many rounds. Every step is an aggregation with map-side combining or a plain inner join, so a
    component with a third of all ids needs no single task. Links with a null end are ignored;
    without links there are no rows.
    """
    pairs = links.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    left = cut(pairs)
    moves: list[DataFrame] = []
    while not left.isEmpty():
        place_of = lambda c: F.xxhash64(c, F.lit(len(moves))) if moves else F.lit(0).cast("long")
        order = lambda c: F.struct(place_of(c).alias("at"), F.col(c).alias("id"))
        both = left.select("src", "dst").unionByName(left.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        best = both.select("src", order("dst").alias("to")).groupBy("src").agg(F.min("to").alias("to"))
        move = cut(best.select(F.col("src").alias("id"), F.least("to", order("src"))["id"].alias("at")))
        src, dst = move.toDF("src", "a"), move.toDF("dst", "b")
        moved = left.join(src, "src").join(dst, "dst").where("a <> b")
        left = cut(moved.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())
        moves.append(move)
    if not moves:
        return pairs.select(F.col("src").alias("id"), F.col("src").alias("component")).limit(0)
    place = moves.pop()
    while moves:
        step = place.toDF("at", "next")
        place = moves.pop().join(step, "at", "left").select("id", F.coalesce("next", "at").alias("at"))
    place = cut(place)
    smallest = place.groupBy("at").agg(F.min("id").alias("component"))
    return place.join(smallest, "at").select("id", F.least("id", "component").alias("component"))


def linked_further(place: DataFrame, links: DataFrame) -> DataFrame:
    """``place(id, component)`` after more ``links(src, dst)``: only components are contracted, not ids again.

    ``links`` may name ids that ``place`` doesn't; null ends are ignored.
    """
    ends = links.join(place.toDF("src", "a"), "src", "left").join(place.toDF("dst", "b"), "dst", "left")
    between = ends.select(F.coalesce("a", "src").alias("src"), F.coalesce("b", "dst").alias("dst"))
    further = cut(components(between)).toDF("component", "next")
    moved = place.join(further, "component", "left").select("id", F.coalesce("next", "component").alias("component"))
    new = further.join(place.select(F.col("id").alias("component")), "component", "left_anti")
    return moved.unionByName(new.select(F.col("component").alias("id"), F.col("next").alias("component")))
