"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

Every shingle is hashed once; its bin is one part of the hash and its value another, so a signature
takes one pass (one-permutation hashing). Empty bins copy the value of a bin that a hash of (bin,
attempt) picks, tried until it is not empty (optimal densification). Bands of bins give buckets.
In a bucket only pairs with one document, its centre, are candidates at first, so a bucket of n
documents gives n - 1 pairs. Documents of a bucket that this leaves in different components are
compared by an exact join on their rarest shingles. Candidates are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.components import components, linked_further
from nodeledger.llm.store import cut, hand_back, written
from nodeledger.llm.wordhash import Block, blocks, mix

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
SETS = "doc_id long, shingles array<long>"
#: Bins of a signature at most.
BINS = 320
#: Counters by which shingles are ordered, in bits. They only order: with more shingles than counters
#: the join meets more pairs and loses none.
RARITY_BITS = 20


def shingles(block: Block, words: int) -> list[np.ndarray]:
    """The distinct shingles of each text of a block, sorted; a shorter text is one shingle."""
    h = block.hashes(exact_long=True)
    out = []
    rolled = np.zeros(max(len(h) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += mix(h[k : k + len(rolled)], k + 2)
    rolled = mix(rolled, 1)
    for a, b in zip(block.word_at[:-1], block.word_at[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        else:
            part = h[a:b]
            whole = sum((mix(part[k : k + 1], 100 + k) for k in range(len(part))), np.full(min(len(part), 1), len(part), np.uint64))
            out.append(mix(whole, 99))
    return out


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of densified bin minima per non-empty set."""
    owner = np.repeat(np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
    h = mix(np.concatenate(sets), 7)
    low = np.uint64(32)
    slot = owner * np.uint64(bins) + (((h >> low) * np.uint64(bins)) >> low)
    keys = np.sort((slot << low) | (h & np.uint64(0xFFFFFFFF)))
    slots = keys >> low
    first = np.concatenate([[True], slots[1:] != slots[:-1]])
    table = np.zeros(len(sets) * bins, np.uint64)
    filled = np.zeros(len(sets) * bins, bool)
    at = slots[first].astype(np.int64)
    table[at], filled[at] = keys[first] & np.uint64(0xFFFFFFFF), True
    origin = filled.copy()
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        bin_no = (empty % bins).astype(np.uint64)
        donor = empty - empty % bins + (mix(bin_no, 1000 + attempt) % np.uint64(bins)).astype(np.int64)
        good = origin[donor]
        table[empty[good]] = table[donor[good]]
        empty = empty[~good]
    return table.reshape(len(sets), bins)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    total = np.zeros(parts.shape[:2], np.uint64)
    for r in range(rows):
        total += mix(parts[:, :, r], 50 + r)
    return mix(total + mix(np.arange(bands, dtype=np.uint64), 49), 48).astype(np.int64)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, rows)]).astype(np.int32), pa.array(flat.astype(np.int64), kind))


def _sign(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                sets = shingles(block, words)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(full, bands * rows), bands) if full else [])
                sums = [(len(s), int(np.add.reduce(mix(s, 11)).astype(np.int64)), int(np.add.reduce(mix(s, 12)).astype(np.int64))) for s in sets]
                n, a, b = zip(*sums)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first, len(sets)), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), _lists([next(keys) if len(s) else np.zeros(0, np.int64) for s in sets], pa.int64())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )
        hand_back()

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                sets = shingles(block, words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(sets)), _lists([s.view(np.int64) for s in sets], pa.int64())], names=["doc_id", "shingles"])
        hand_back()

    return run


def missed(similarity: float, bands: int, rows: int) -> float:
    """The probability that a pair shares no bucket, on independent bins."""
    return (1 - similarity**rows) ** bands


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows) of at most ``BINS`` bins: the longest bands that miss a pair at ``percent`` in one of 100,000 cases at most."""
    rows = max((r for r in range(1, 17) if missed(percent / 100, BINS // r, r) <= 1e-5), default=1)
    return BINS // rows, rows


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs(doc_id, text)``.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their shingle sets.
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the own one.
    A pair that shares a bucket is linked or joined by way of others for sure.
    ``bands`` and ``rows`` follow from ``percent`` unless both are given. The search misses a pair
    if it shares no bucket, on independent bins with probability 0.0000001 at 0.80 (53 bands of 6)
    and 0.000003 at 0.85 (40 bands of 8); more often for sets of a few shingles, which fill few bins:
    1 of 3,000 pairs of sets of 7 shingles.

    Null, empty and word-less texts have no shingles and are linked with nothing. A null doc_id has
    a null component and is kept. Repeated rows give as many rows; rows that share an id are one
    document for links. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    if bands is None or rows is None:
        bands, rows = banding(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(docs.mapInArrow(_sign(words, bands, rows), SIGNATURE), "minhash")
    same = signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    # equal sets are one member of buckets
    reps = signed.join(same.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").where("n_shingles > 0")
    spread = reps.select("doc_id", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = written(spread.join(shared.select("bucket"), "bucket", "left_semi").distinct(), "buckets")
    named = members.select("doc_id").distinct()
    sets = written(docs.join(named, "doc_id", "left_semi").mapInArrow(_sets(words), SETS), "sets")
    place = _places(members, sets, percent).toDF("rep", "component")
    own = signed.join(same, ["set_a", "set_b", "n_shingles"], "left").join(place, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return own.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that aren't the first of their component; rows unchanged.

    Rows that share an id stay or go together.
    """
    # a semi-join by name of columns that the table may have too
    taken = "_gone" + "_" * max((len(c) for c in docs.columns), default=0)
    gone = near_duplicates(docs, words, percent).where("not kept").select(F.col("doc_id").alias(taken)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(taken), "left_anti")


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (doc_id, centre) whose full sets are alike, as links (src, dst)."""
    size = lambda c: F.size(c).cast("long")
    both = pairs.join(sets, "doc_id").join(sets.toDF("centre", "other"), "centre")
    both = both.withColumn("common", size(F.array_intersect("shingles", "other")))
    alike = 100 * F.col("common") >= percent * (size("shingles") + size("other") - F.col("common"))
    return both.where(alike).select(F.col("doc_id").alias("src"), F.col("centre").alias("dst")).distinct()


def _places(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, component) of all documents of ``members(bucket, doc_id)`` with links.

    Stars come first, around the smallest document of each bucket: they join large groups with few
    pairs. What then shares a bucket and lies in two components is still open; `_between` tests it
    exactly, and its links join whole components.
    """
    centre = members.groupBy("bucket").agg(F.min("doc_id").alias("centre"))
    pairs = members.join(centre, "bucket").where("doc_id <> centre").select("doc_id", "centre").distinct()
    place = cut(components(_alike(pairs, sets, percent)))
    left = _open(members, place).select("doc_id", "component").distinct()
    return linked_further(place, _between(cut(left), sets, percent))


def _rarity(sets: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    return np.bincount((mix(flat.view(np.uint64), 31) >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=1 << RARITY_BITS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << RARITY_BITS, np.int64)
    for batch in batches:
        total += _rarity([batch.column(0).flatten().to_numpy()])
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(total[slot])], names=["slot", "n"])


def _prefixes(counts: np.ndarray, percent: int):
    """The rarest shingles of each set, as many as it takes for two sets that are alike to share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            size = np.diff(at)
            owner = np.repeat(np.arange(len(size)), size)
            rare = counts[(mix(flat.view(np.uint64), 31) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]
            order = np.lexsort((flat, rare, owner))
            rank = np.arange(len(flat)) - at[owner]
            wanted = rank <= (size - -(-size * percent // 100))[owner]
            flat, owner, rank = flat[order][wanted], owner[wanted], rank[wanted]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(take), batch.column(1).take(take), pa.array(size[owner]), pa.array(rank)], names=["shingle", "doc_id", "component", "n", "rank"])

    return run


def _between(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between documents of ``left(doc_id, component)`` in different components, without a miss.

    Sets of n and m shingles that are alike have at least percent / (100 + percent) * (n + m) in
    common, so in any fixed order of shingles each has a common one among its first ones. The order
    is from rare to frequent, so shingles of templates and common lines come last.
    """
    mine = left.join(sets, "doc_id").select("doc_id", "component", "shingles")
    # eighths of the binary logarithm of each counter, one byte each
    counts = np.zeros(1 << RARITY_BITS, np.uint8)
    added = sets.select("shingles").mapInArrow(_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    size = F.least(F.lit(255), F.floor(F.log2("n") * 8)).cast("short")
    slots = added.where("n > 1").select("slot", size.alias("size")).toArrow()
    counts[slots.column("slot").to_numpy()] = slots.column("size").to_numpy()
    entry = mine.mapInArrow(_prefixes(counts, percent), "shingle long, doc_id long, component long, n long, rank long")
    # a shingle of one component has no pair; of the others, pairs within its largest component are not formed
    by = entry.groupBy("shingle", "component").count().groupBy("shingle")
    several = by.agg(F.count("*").alias("kinds"), F.max_by("component", F.struct("count", "component")).alias("most")).where("kinds > 1")
    entry = cut(entry.join(several.select("shingle", "most"), "shingle"))
    a, b = entry.where("component <> most").alias("a"), entry.alias("b")
    need = "ceil({p} * (a.n + b.n) / (100 + {p}))".format(p=percent)
    fits = F.expr(
        "a.component <> b.component and (b.component = b.most or a.doc_id < b.doc_id) and 100 * least(a.n, b.n) >= {p} * greatest(a.n, b.n) "
        "and a.rank <= a.n - {need} and b.rank <= b.n - {need}".format(p=percent, need=need)
    )
    pairs = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & fits)
    pairs = pairs.select(F.least("a.doc_id", "b.doc_id").alias("doc_id"), F.greatest("a.doc_id", "b.doc_id").alias("centre")).distinct()
    return _alike(pairs, sets, percent)


def _open(members: DataFrame, place: DataFrame) -> DataFrame:
    """(bucket, doc_id, component) of the buckets with documents of more than one component."""
    located = members.join(place.toDF("doc_id", "at"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("at", "doc_id").alias("component"))
    ends = located.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return located.join(ends.where("low < high").select("bucket"), "bucket", "left_semi")
