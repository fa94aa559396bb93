"""Document quality: hashed word n-gram logistic regression fitted by FTRL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm import linear
from nodeledger.llm.store import hand_back
from nodeledger.llm.wordhash import Block, blocks, mix

#: Labelled rows per class that a model is fitted on at most.
SAMPLE_PER_CLASS = 3000
#: Total value of a text's features; keeps long and short texts on one scale.
SCALE = 8.0


def word_ngrams(block: Block) -> linear.Rows:
    """Single words and pairs of words, as written and as shapes, as shares of the text.

    A word equal to the one before it counts as the pair feature "again" instead of its own pair.
    """
    words, shapes, text = block.hashes(fold_case=False), block.shapes(), block.text_of_word()
    same_text = text[1:] == text[:-1]
    a, b = words[:-1][same_text], words[1:][same_text]
    pairs = np.where(a == b, np.uint64(1), mix(a, 21) + b)
    shape_pairs = mix(shapes[:-1][same_text], 22) + shapes[1:][same_text]
    parts = [(text, mix(words, 31)), (text[1:][same_text], mix(pairs, 32)), (text, mix(shapes, 33)), (text[1:][same_text], mix(shape_pairs, 34))]
    owner = np.concatenate([p[0] for p in parts])
    index = np.concatenate([p[1] for p in parts]) % np.uint64(linear.BUCKETS)
    share = SCALE / np.maximum(np.diff(block.word_at), 1)
    return linear.merged(owner, index, share[owner], block.texts())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float]:
    """(weights, bias) from ``labels(doc_id, quality)``; without labels everything scores 0.5.

    A label class with fewer rows in the sample weighs as much as the other one.
    """
    texts, y = linear.labelled_sample(docs, labels, "quality", per_class)
    if not texts:
        return np.zeros(linear.BUCKETS, np.float32), 0.0
    share = max(y.mean(), 1e-9), max(1 - y.mean(), 1e-9)
    weight = np.where(y == 1, 0.5 / share[0], 0.5 / share[1])
    return linear.fit_ftrl(linear.features(texts, word_ngrams), y, weight)


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score) for every row of ``docs(doc_id, text)``.

    Null, empty and word-less texts have no features and get the score of the bias alone. A null
    doc_id is not held out. Repeated rows are scored alike; an empty table gives an empty result.
    Other columns of ``docs`` are not read.
    """
    scores = linear.scored(docs, word_ngrams, *fit(docs, labels, per_class))
    return scores.select("doc_id", F.coalesce(linear.held_out("doc_id"), F.lit(False)).alias("held_out"), "score")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    weights, bias = fit(docs, labels, per_class)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [linear.sigmoid(word_ngrams(b).dot(weights) + bias) for b in blocks(batch.column(where).cast(pa.string()))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= threshold))
        hand_back()

    return docs.mapInArrow(run, docs.schema)
