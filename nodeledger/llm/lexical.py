"""Ranked lexical search over bit-sliced Bloom signatures.

Each document of a block has a Bloom signature of its terms, entered once for every level of
occurrences (1, 2, 4, 8 or more). Signatures are stored by slice: the bitmap of one place over all
documents of the block. The intersection of a term's slices holds every document with the term and
perhaps others, so sums of weights over slices, level by level, bound scores from above. Documents that
the bound doesn't exclude from the best are scored exactly on their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.llm.store import written
from nodeledger.llm.terms import LETTERS_AND_DIGITS, Terms, blocks_of_terms
from nodeledger.llm.wordhash import _BASE, _CODE, _INVERSE, mix, powers

#: Bytes and documents of a block; a longer document is a block of its own.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 512
#: Occurrences from which a term is entered at each level, hashes of an entry, places for each entry of the fullest signature.
LEVELS, HASHES, ROOM = (1, 2, 4, 8), 3, 12
#: Items and bytes of items that one pass over the index answers.
ITEMS, ITEM_BYTES = 512, 1 << 20
#: Groups in which the best of tasks are ranked before they meet.
SALTS = 64
INDEX = "doc_ids array<long>, texts array<string>, n array<long>, terms array<binary>, df array<int>, places int, slices binary"


def _hashes(vocabulary: pa.LargeBinaryArray) -> np.ndarray:
    """A 64-bit value for each term; terms with one value share slices, nothing more."""
    flat = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary.cast(pa.binary())), b"")[0].as_py()
    data = np.frombuffer(flat, np.uint8)
    at = np.append(0, np.cumsum(pc.binary_length(vocabulary).to_numpy()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * powers(_BASE, len(data)), out=total[1:])
    return mix((total[at[1:]] - total[at[:-1]]) * powers(_INVERSE, len(data) + 1)[at[:-1]])


def _places(hashed: np.ndarray, level: int, places: int) -> list[np.ndarray]:
    return [(mix(hashed, 100 * level + j) & np.uint64(places - 1)).astype(np.int64) for j in range(HASHES)]


def _signatures(block: Terms) -> tuple[int, bytes, np.ndarray]:
    """Places of a signature, the slices one after another, and the documents that hold each term."""
    doc, term, count = block.counts()
    entries = sum(np.bincount(doc[count >= level], minlength=block.texts()) for level in LEVELS)
    places = 1 << max(6, math.ceil(math.log2(ROOM * max(1, int(entries.max())))))
    bits = np.zeros((places, block.texts()), bool)
    hashed = _hashes(block.vocabulary)
    for k, level in enumerate(LEVELS):
        at = count >= level
        for place in _places(hashed, k, places):
            bits[place[term[at]], doc[at]] = True
    return places, np.packbits(bits, axis=1).tobytes(), np.bincount(term, minlength=len(block.vocabulary))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0)
        # alike in length within a block, as its signatures are as long as the fullest needs
        batch = batch.take(pc.sort_indices(size))
        for block in blocks_of_terms(batch.column(1), LETTERS_AND_DIGITS, BLOCK_BYTES, BLOCK_DOCS):
            places, slices, df = _signatures(block)
            mine = batch.slice(block.first, block.texts())
            lists = (mine.column(0), mine.column(1), pa.array(np.diff(block.at), pa.int64()), block.vocabulary.cast(pa.binary()), pa.array(df, pa.int32()))
            rows = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists]
            yield pa.RecordBatch.from_arrays([*rows, pa.array([places], pa.int32()), pa.array([slices], pa.binary())], names=[c.split()[0] for c in INDEX.split(", ")])


def build_index(docs: DataFrame) -> DataFrame:
    """The index of every row of ``docs(doc_id, text)``, a table in the shared folder, one row per block."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return written(rows.mapInArrow(_index, INDEX), "slices", group_mb=16)


class Queries:
    """Some items: their distinct terms, weights, and which items hold which term how often."""

    def __init__(self, texts: list[str | None]):
        found = next(blocks_of_terms(pa.array([t or "" for t in texts], pa.string()), LETTERS_AND_DIGITS, 1 << 40))
        item, term, count = found.counts()
        order = np.argsort(term, kind="stable")
        self.items, self.vocabulary, self.hashed = len(texts), found.vocabulary.cast(pa.binary()), _hashes(found.vocabulary)
        self.item, self.repeats = item[order], count[order]
        self.begin = np.searchsorted(term[order], np.arange(len(found.vocabulary) + 1))
        self.weight = np.zeros(len(found.vocabulary), np.int64)

    def weigh(self, df: dict[bytes, int], n_docs: int) -> None:
        for k, term in enumerate(self.vocabulary.to_pylist()):
            self.weight[k] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(term, 0) + 1)))

    def spread(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``term``, item, weight with repeats) of every item that holds one of these terms."""
        many = self.begin[term + 1] - self.begin[term]
        source = np.repeat(np.arange(len(term)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + self.begin[term][source]
        return source, self.item[at], self.weight[term[source]] * self.repeats[at]


def _bounds(queries: Queries, known: np.ndarray, slices: np.ndarray, places: int, m: np.ndarray) -> np.ndarray:
    """What no document of the block scores more than, by item and document."""
    n = len(m)
    out, below = np.zeros((queries.items, n)), np.zeros(n)
    for k, level in enumerate(LEVELS):
        place = _places(queries.hashed[known], k, places)
        holds = np.bitwise_and.reduce([slices[p] for p in place])
        term, doc = np.nonzero(np.unpackbits(holds, axis=1, count=n))
        source, item, weight = queries.spread(known[term])
        sums = np.bincount(item * n + doc[source], weights=weight, minlength=queries.items * n).reshape(queries.items, n)
        most = LEVELS[k + 1] - 1 if k + 1 < len(LEVELS) else None
        # what so many occurrences add at most, above the level before
        above = 1e9 * most / (1000 * most + 8 * m) if most else np.full(n, 1e6)
        out += sums * (above - below)
        below = above
    return out * (1 + 1e-9) + 1


def _exact(queries: Queries, texts: pa.Array, m: np.ndarray) -> np.ndarray:
    """Scores by item and text."""
    out = np.zeros((queries.items, len(texts)), np.int64)
    for block in blocks_of_terms(texts, LETTERS_AND_DIGITS, BLOCK_BYTES):
        doc, term, tf = block.counts()
        asked = pc.index_in(block.vocabulary.cast(pa.binary()), queries.vocabulary)
        asked = pc.fill_null(asked, -1).to_numpy()[term]
        doc, term, tf = doc[asked >= 0] + block.first, asked[asked >= 0], tf[asked >= 0]
        part = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        source, item, weight = queries.spread(term)
        np.add.at(out, (item, doc[source]), weight * part[source])
    return out


class Best:
    """The leading documents of each item so far."""

    def __init__(self, items: int, ranks: int):
        self.ranks, self.score = ranks, np.zeros((items, ranks), np.int64)
        self.doc, self.named = np.zeros((items, ranks), np.int64), np.ones((items, ranks), bool)

    def least(self) -> np.ndarray:
        return np.maximum(self.score[:, -1:], 1)

    def add(self, score: np.ndarray, doc: np.ndarray, named: np.ndarray) -> None:
        items = np.flatnonzero((score >= self.least()).any(1))
        wide = lambda a, b: np.concatenate([a[items], np.broadcast_to(b, (len(items), b.shape[-1]))], axis=1)
        s, d, k = wide(self.score, score[items]), wide(self.doc, doc), wide(self.named, named)
        order = np.lexsort((d, ~k, -s), axis=-1)[:, : self.ranks]
        self.score[items], self.doc[items], self.named[items] = (np.take_along_axis(x, order, 1) for x in (s, d, k))


def _search(queries: Queries, n_docs: int, n_terms: int, ranks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(queries.items, ranks)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts, n, terms = (batch.column(c)[i].values for c in range(4))
                known = pc.index_in(queries.vocabulary, terms)
                known = np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False))
                if not len(known):
                    continue
                places = batch.column(4)[i].as_py()
                slices = np.frombuffer(batch.column(5)[i].as_py(), np.uint8).reshape(places, -1)
                m = np.array([25 + 75 * k * n_docs // n_terms for k in n.to_pylist()], np.int64)
                named = ids.is_valid().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(ids, 0).to_numpy()
                bound = _bounds(queries, known, slices, places, m)
                # the highest bounds of each item first: they raise what the others must reach
                few = min(ranks, len(ids))
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, np.argpartition(-bound, few - 1, axis=1)[:, :few], True, axis=1)
                open_now = np.ones(len(ids), bool)
                for chosen in (first, True):
                    wanted = np.flatnonzero(((bound >= best.least()) & chosen & open_now).any(0))
                    if len(wanted):
                        best.add(_exact(queries, texts.take(pa.array(wanted)), m[wanted]), ids[wanted], named[wanted])
                        open_now[wanted] = False
        item, rank = np.nonzero(best.score > 0)
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(np.full(len(item), salt), pa.int32()), pa.array(best.doc[item, rank], pa.int64(), mask=~best.named[item, rank]), pa.array(best.score[item, rank])],
            names=["item", "salt", "doc_id", "score"],
        )

    return run


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        if block and (len(block) == ITEMS or size + len(row[1] or "") > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append(tuple(row))
        size += len(row[1] or "")
    if block:
        yield block


def ranked_search(index: DataFrame, items: DataFrame, ranks: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``ranks`` best documents of an index for each row of ``items(item_id, text)``.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A to Z in lower case. A
    score adds, over the terms of the item with repeats, the term's weight floor(1000 ln((2N + 2) /
    (2df + 1))) times 10**9 tf div (1000 tf + 8m), m = 25 + 75 n N div L: n terms of the document,
    N documents with terms, L all their terms, df documents with the term, tf its occurrences. Equal
    scores go by doc_id, a missing one last. Documents that score 0 aren't ranked.

    Items are answered in blocks, each in one pass over all of the index. A row is a document or an
    item: repeated rows count and rank as often, and rows that share an item_id have a list each. Null
    and empty texts have no terms; items without a known term, an empty index or no items give no rows.
    Other columns are not read.
    """
    n_docs, n_terms = index.select(F.explode("n").alias("n")).where("n > 0").agg(F.count("*"), F.sum("n")).first()
    listed = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    found = []
    for block in _item_blocks(items):
        queries = Queries([text for _, text in block])
        if not n_docs or not len(queries.vocabulary):
            continue
        spark = index.sparkSession
        asked = spark.createDataFrame([(bytearray(t),) for t in queries.vocabulary.to_pylist()], "term binary")
        df = listed.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df")).collect()
        queries.weigh({bytes(t): n for t, n in df}, n_docs)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item int, item_id long")
        rows = index.select("doc_ids", "texts", "n", "terms", "places", "slices").mapInArrow(_search(queries, n_docs, n_terms, ranks), "item int, salt int, doc_id long, score long")
        order = (F.desc("score"), F.asc_nulls_last("doc_id"))
        for group in (["item", "salt"], ["item"]):
            rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= ranks)
        found.append(written(rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not found:
        return index.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
