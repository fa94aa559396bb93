"""Sparse linear models over hashed features: labelled samples, FTRL training, scoring in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.wordhash import Block, blocks

#: Hashed feature space; a model is one float per bucket.
BUCKETS = 1 << 18


@dataclass
class Rows:
    """Sparse rows: row i has features index[at[i]:at[i + 1]] with the same slice of value."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.index] * self.value)])
        return total[self.at[1:]] - total[self.at[:-1]]


def merged(text: np.ndarray, index: np.ndarray, value: np.ndarray, texts: int, width: int = BUCKETS) -> Rows:
    """Rows from (text, feature, value) triples; values of a repeated feature are added up."""
    key, inverse = np.unique(text.astype(np.int64) * width + index.astype(np.int64), return_inverse=True)
    return Rows(np.searchsorted(key, np.arange(texts + 1) * width), key % width, np.bincount(inverse, value, len(key)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_ftrl(rows: Rows, target: np.ndarray, weight: np.ndarray | None = None, passes: int = 5, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-4, seed: int = 7, width: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Logistic regression by FTRL-proximal updates, one row after another; (weights, bias).

    ``target`` may be a probability. The gradient sums z and squares n are kept per feature; a
    weight is worked out from them when its feature comes up, and is 0 while |z| <= l1.
    """
    z, n = np.zeros(width + 1), np.zeros(width + 1)
    weight = np.ones(len(target)) if weight is None else weight

    def of(i: np.ndarray) -> np.ndarray:
        pull = np.where(i == width, 0.0, l1)
        return np.where(np.abs(z[i]) <= pull, 0.0, (np.sign(z[i]) * pull - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(passes):
        for r in order.permutation(len(target)):
            part = slice(rows.at[r], rows.at[r + 1])
            i = np.append(rows.index[part], width)
            x = np.append(rows.value[part], 1.0)
            w = of(i)
            g = (sigmoid(np.dot(w, x)) - target[r]) * weight[r] * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    w = of(np.arange(width + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame | None:
    """(doc_id, y, text) of at most ``per_class`` rows of each label outside the held-out fifth; None without any.

    The rows are those first in the order of a hash of their id, so that the sample depends on
    nothing else. Rows without an id or a label and repeated ids are not used.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.min("y").alias("y")).withColumn("turn", F.xxhash64("doc_id"))
    picked = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy("turn", "doc_id").limit(per_class).select("doc_id", "y").collect()]
    if not picked:
        return None
    wanted = spark.createDataFrame(picked, "doc_id long, y int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most 2 * per_class rows of two numbers are broadcast
    return rows.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "y", "text")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of :func:`labelled_rows`, by doc_id."""
    rows = labelled_rows(docs, labels, label, per_class)
    if rows is None:
        return [], np.zeros(0)
    found = rows.toPandas().sort_values("doc_id")
    return list(found["text"]), found["y"].to_numpy(float)


def held_out(c: str):
    return F.crc32(F.col(c).cast("string").cast("binary")) % 5 == 0


def features(texts: list[str], of: Callable[[Block], Rows]) -> Rows:
    parts = [of(b) for b in blocks(pa.array(texts, pa.string()))]
    sizes = np.cumsum([0, *(len(p.index) for p in parts)])
    at = np.concatenate([p.at[:-1] + s for p, s in zip(parts, sizes)] + [sizes[-1:]])
    return Rows(at.astype(np.int64), np.concatenate([p.index for p in parts]), np.concatenate([p.value for p in parts]))


def scored(docs: DataFrame, of: Callable[[Block], Rows], weights: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, score) for every row: the logistic function of a sparse dot product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                score = sigmoid(of(block).dot(weights) + bias)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.texts()), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
