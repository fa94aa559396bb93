"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are projected on their leading principal dimensions and sorted by the grid cells, of
the width of the distance limit, that they fall in. Equal stretches of that sequence are blocks;
stretches of 2, 4, 8, ... blocks are intervals with a bounding box each. The join starts with the
whole sequence against itself and goes down interval by interval, dropping pairs whose boxes lie
farther apart than the limit; a projection never lengthens a distance, so no link is lost. Pairs of
blocks that are left are multiplied out in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.llm.components import components
from nodeledger.llm.store import cut, written

#: Vectors in a block, rows of a product at a time, and principal dimensions of the grid.
BLOCK, ROWS, LEADING = 4096, 512, 8
_LINKED = "vec_id long, n long, other long"


def _matrix(column: pa.Array) -> np.ndarray:
    """The equally long vectors of a column, scaled to length 1."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    # by the largest component first: squares of very large or small ones leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v): one vector per id, none that is null, empty, zero or not finite."""
    v = F.col("v")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", F.size("v").alias("dim"), "v")


def _axes(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal directions; from sums, one row per entry and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = np.column_stack([_matrix(batch.column(0)), np.ones(len(batch))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "sum"])

    summed = rows.select("v").mapInArrow(run, "at long, sum double").groupBy("at").agg(F.sum("sum").alias("sum"))
    total = np.zeros((dim + 1) ** 2)
    for r in summed.collect():  # (dim + 1) ** 2 numbers
        total[r["at"]] = r["sum"]
    total = total.reshape(dim + 1, dim + 1)
    mean = total[-1, :-1] / max(total[-1, -1], 1)
    covariance = total[:-1, :-1] / max(total[-1, -1], 1) - np.outer(mean, mean)
    return mean, np.linalg.eigh(covariance)[1][:, ::-1][:, : min(LEADING, dim)]


def _sequence(rows: DataFrame, dim: int, limit: float) -> DataFrame:
    """(block, vec_id, v, y): vectors numbered in epsilon grid order, cut into blocks."""
    mean, axes = _axes(rows, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (_matrix(batch.column(1)) - mean) @ axes
            lists = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), axes.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "v", "y"])

    placed = written(rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, y array<double>"), "placed")
    cells = F.transform("y", lambda x: F.floor(x / limit))
    # the id splits cells that hold many vectors
    order = [F.element_at("cell", k + 1) for k in range(axes.shape[1])] + [F.col("vec_id")]
    keys = placed.select("vec_id", cells.alias("cell")).repartitionByRange(*order)
    keys = cut(keys.withColumn("part", F.spark_partition_id()))
    # one row per range
    sizes = keys.groupBy("part").agg(F.count("*").alias("n"))
    ahead = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    ranked = keys.withColumn("place", place).join(ahead, "part").select("vec_id", F.floor((F.col("place") + F.col("ahead")) / BLOCK).alias("block"))
    return placed.join(ranked, "vec_id")


def _blocks(sequence: DataFrame, leading: int) -> DataFrame:
    """One row per block: its ids and vectors, and its bounding box."""
    box = [f(F.element_at("y", k + 1)).alias(f"{n}{k}") for k in range(leading) for n, f in (("lo", F.min), ("hi", F.max))]
    packed = F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("members")  # BLOCK members
    return sequence.groupBy("block").agg(packed, *box)


def _close_pairs(boxes: DataFrame, leading: int, limit: float) -> DataFrame:
    """(a, b), a <= b: blocks whose boxes are within the limit, found interval by interval."""
    last = boxes.agg(F.max("block")).first()[0]
    levels = 0 if last is None else max(int(last).bit_length(), 0)
    sides = [f(f"{n}{k}").alias(f"{n}{k}") for k in range(leading) for n, f in (("lo", F.min), ("hi", F.max))]

    def at(level: int, name: str) -> DataFrame:
        node = F.shiftright("block", level)
        intervals = boxes.withColumn("node", node).groupBy("node").agg(*sides)
        return intervals.select(F.col("node").alias(name), F.shiftright("node", 1).alias(f"{name}_above"), *(F.col(f"{n}{k}").alias(f"{name}_{n}{k}") for k in range(leading) for n in ("lo", "hi")))

    pairs = None
    for level in range(levels, -1, -1):
        a, b = at(level, "a"), at(level, "b")
        if pairs is None:  # a single interval
            joined = a.join(b, F.col("a") == F.col("b"))
        else:
            above = pairs.select(F.col("a").alias("a_above"), F.col("b").alias("b_above"))
            joined = above.join(a, "a_above").join(b, "b_above").where("a <= b")
        gap = [F.greatest(F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}"), F.lit(0.0)) for k in range(leading)]
        distance = sum((g * g for g in gap), F.lit(0.0))
        pairs = joined.where(distance <= limit * limit).select("a", "b")
        if level % 4 == 0:
            pairs = cut(pairs)
    return pairs


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest position of its set) after joining the sets of i[k] and j[k]."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                a_no, b_no = (batch.column(k)[row].as_py() for k in (0, 1))
                sides = [batch.column(k)[row].values for k in (2, 3)]
                ids = [s.field("vec_id").to_numpy() for s in sides]
                x, z = (_matrix(s.field("v")) for s in sides)
                both, shift = (ids[0], 0) if a_no == b_no else (np.concatenate(ids), len(ids[0]))
                label, n = np.arange(len(both)), np.zeros(len(both), np.int64)
                for top in range(0, len(x), ROWS):
                    i, j = np.nonzero(x[top : top + ROWS] @ z.T >= threshold)
                    i += top
                    keep = i != j if shift == 0 else slice(None)
                    i, j = i[keep], j[keep] + shift
                    n += np.bincount(i, minlength=len(both))
                    if shift:
                        n += np.bincount(j, minlength=len(both))
                    label = unite(label, i, j)
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(both[hit]), pa.array(n[hit]), pa.array(both[label[hit]])], names=["vec_id", "n", "other"])

    return run


def embedding_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Vectors with a cosine of ``threshold`` or more are linked; ``n_links`` counts the linked ids,
    ``component_id`` is the smallest id reachable, itself included.

    Null, empty and zero vectors and those with null or non-finite components link with nothing,
    and vectors of different lengths don't link. Rows that share an id are one vector, the first
    usable one in array order. A null id has a null component and is kept. An empty table gives no
    rows. Other columns aren't read.
    """
    limit = math.sqrt(max(2 - 2 * threshold, 0)) + 1e-9
    usable = _usable(vectors)
    found = None
    for dim in sorted(r["dim"] for r in usable.select("dim").distinct().collect()):  # lengths that occur
        rows = usable.where(F.col("dim") == dim)
        leading = min(LEADING, dim)
        blocks = written(_blocks(_sequence(rows, dim, limit), leading), "blocks")
        pairs = _close_pairs(blocks.drop("members"), leading, limit)
        data = blocks.select("block", "members")
        product = pairs.join(data.toDF("a", "left"), "a").join(data.toDF("b", "right"), "b").select("a", "b", "left", "right")
        linked = written(product.mapInArrow(_links(threshold), _LINKED), "links")
        found = linked if found is None else found.unionByName(linked)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if found is None:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    place = components(found.select(F.col("vec_id").alias("src"), F.col("other").alias("dst"))).toDF("vec_id", "place")
    component = F.coalesce("place", "vec_id")
    return base.join(counts, "vec_id", "left").join(place, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
