"""How far the sources of a language differ: term shares over the terms that enough documents hold.

Terms are found by iceberg prefix refinement. Documents become a table of their distinct terms once.
Level by level the first 2, 4, 8, ... bytes of terms are counted by document; a prefix with fewer
documents than the threshold is discarded, and the next level only counts longer prefixes of those
that stay, until no incomplete one does. A term ends its refinement at the level that holds it whole.
Shares and differences are whole numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeledger.llm.store import cut, written
from nodeledger.llm.terms import LETTERS, blocks_of_terms

#: Bytes of text whose terms share a row of the table, and bytes of the first level.
BLOCK, FIRST = 1 << 23, 2
#: Places of a sieve, a bitmap of hashed prefixes. It has one size: a full one lets more through to the exact test.
PLACES = 1 << 23
_BUCKET = 1 << 15
#: Kept terms that are compared together, and cells of a matrix of terms by sources.
TERMS, CELLS = 2048, 1 << 20

TABLE = "lang string, terms array<binary>, doc_ends array<int>, doc_terms array<int>, sources array<string>, of_source array<int>, of_term array<int>, n array<long>"
GROUP = "lang string, source string, part string, item string, value long"


def _term_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and block of documents: their terms, each document's, and counts by source."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            mine = batch.filter(pc.equal(langs.indices, k))
            for block in blocks_of_terms(mine.column(2), LETTERS, BLOCK):
                text, term, count = block.counts()
                named = mine.column(1).slice(block.first, block.texts()).dictionary_encode()
                width = max(len(block.vocabulary), 1)
                key, where = np.unique(named.indices.to_numpy()[text].astype(np.int64) * width + term, return_inverse=True)
                n = np.zeros(len(key), np.int64)
                np.add.at(n, where, count)
                ends = np.cumsum(np.bincount(text, minlength=block.texts()))
                row = (block.vocabulary.cast(pa.binary()), pa.array(ends, pa.int32()), pa.array(term, pa.int32()), named.dictionary, pa.array(key // width, pa.int32()), pa.array(key % width, pa.int32()), pa.array(n))
                one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in row]
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), *one], names=[c.split()[0] for c in TABLE.split(", ")])


class Sieve:
    """Lets (language, bytes) through that were put in, and by chance others."""

    def __init__(self, kept: DataFrame, column: str):
        place = F.crc32(F.concat(F.encode("lang", "utf-8"), F.lit(b"\0"), column)) % PLACES + 1
        bits = kept.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        # at most PLACES / _BUCKET rows of 4 KB
        rows = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toArrow()
        self.bits = np.zeros(PLACES // 8, np.uint8)
        for bucket, part in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
            at = (bucket - 1) * _BUCKET // 8
            self.bits[at : at + len(part)] = np.frombuffer(part, np.uint8)

    def passes(self, lang: str, values: pa.Array) -> np.ndarray:
        seed = zlib.crc32(lang.encode() + b"\0")
        place = np.array([zlib.crc32(v.as_py(), seed) % PLACES for v in values], np.int64)
        return (self.bits[place >> 3] >> (place & 7) & 1).astype(bool)


def _runs(values: pa.Array) -> np.ndarray:
    """Whether each of some sorted values differs from the one before it."""
    return np.append(True, pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False))[: len(values)]


def _level(before: int, size: int, sieve: Sieve | None):
    """(lang, prefix, complete, docs) of terms longer than ``before``, of kept beginnings, cut to ``size`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, terms = batch.column(0)[i].as_py(), batch.column(1)[i].values
                wanted = pc.greater(pc.binary_length(terms), before).to_numpy(zero_copy_only=False).copy()
                if sieve is not None and wanted.any():
                    begin = pc.binary_slice(terms.filter(pa.array(wanted)), 0, before)
                    new = _runs(begin)
                    wanted[wanted] = sieve.passes(lang, begin.filter(pa.array(new)))[np.cumsum(new) - 1]
                if not wanted.any():
                    continue
                mine = terms.filter(pa.array(wanted))
                complete = pc.less_equal(pc.binary_length(mine), size).to_numpy(zero_copy_only=False)
                prefix = pc.binary_slice(mine, 0, size)
                new = _runs(prefix) | np.append(True, complete[1:] != complete[:-1])
                run_of = np.full(len(terms), -1)
                run_of[wanted] = np.cumsum(new) - 1
                ends, doc_terms = batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()
                found, doc = run_of[doc_terms], np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                found, doc = found[found >= 0], doc[found >= 0]
                # terms of a document ascend, so equal prefixes are neighbours
                once = np.append(True, (found[1:] != found[:-1]) | (doc[1:] != doc[:-1]))[: len(found)]
                docs = np.bincount(found[once], minlength=int(new.sum()))
                head = prefix.filter(pa.array(new))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(head), pa.string()), head, pa.array(complete[new]), pa.array(docs, pa.int64())], names=["lang", "prefix", "complete", "docs"])

    return run


def _counts(sieve: Sieve):
    """(lang, term, source, n) of the terms that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, terms, sources = batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(2)[i].values
                of_source, of_term, n = (batch.column(c)[i].values for c in (3, 4, 5))
                good = pa.array(sieve.passes(lang, terms)[of_term.to_numpy()])
                of_source, of_term, n = of_source.filter(good), of_term.filter(good), n.filter(good)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), terms.take(of_term), sources.take(of_source), n], names=["lang", "term", "source", "n"])

    return run


def term_table(docs: DataFrame) -> DataFrame:
    """The terms of ``docs(text, lang, source)`` in the shared folder, as the other functions read them."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return written(docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(_term_table, TABLE), "terms", group_mb=16)


def kept_terms(table: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms that at least ``least`` documents of the language hold."""
    rows = table.select("lang", "terms", "doc_ends", "doc_terms")
    before, size, sieve, kept = 0, FIRST, None, None
    while True:
        counted = rows.mapInArrow(_level(before, size, sieve), "lang string, prefix binary, complete boolean, docs long")
        stay = cut(counted.groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs"))
        done = stay.where("complete").select("lang", F.col("prefix").alias("term"))
        kept = done if kept is None else kept.unionByName(done)
        longer = stay.where("not complete").select("lang", "prefix")
        if longer.isEmpty():
            return kept
        before, size, sieve = size, 2 * size, Sieve(longer, "prefix")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(1000000000 * part / whole), part at most whole, by long division: nothing above 1000 * whole occurs."""
    out = np.zeros_like(part)
    rest = part
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _compare(least_ranks: int):
    """Differences within one block of kept terms: sums by pair of sources, and each source's leading terms."""

    def run(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        groups = groups.sort_by("source")
        sources = groups.column("source").combine_chunks()
        whole = groups.column("total").to_numpy() + 5 * groups.column("terms").to_numpy()
        overall = groups.column("total").to_numpy().sum() + 5 * (groups.column("terms")[0].as_py() if len(sources) else 0)
        coded = counts.column("term").combine_chunks().dictionary_encode()
        rows, columns = coded.indices.to_numpy(), pc.index_in(counts.column("source").combine_chunks(), sources).to_numpy()
        order = np.argsort(rows, kind="stable")
        rows, columns, n = rows[order], columns[order], counts.column("n").to_numpy()[order]
        apart = np.zeros((len(sources), len(sources)), np.int64)
        lead: list[list[tuple[int, bytes]]] = [[] for _ in sources]
        step = max(1, CELLS // max(1, len(sources)))
        for low in range(0, len(coded.dictionary), step):
            names = coded.dictionary.slice(low, step)
            a, b = np.searchsorted(rows, [low, low + len(names)])
            table = np.zeros((len(names), len(sources)), np.int64)
            table[rows[a:b] - low, columns[a:b]] = n[a:b]
            p = _share(table + 5, whole[None, :])
            q = _share(table.sum(1) + 5, np.full(len(names), overall))
            for s in range(len(sources)):
                apart[s] += np.abs(p - p[:, s : s + 1]).sum(0)
                above = np.flatnonzero((table[:, s] > 0) & (p[:, s] > q))
                more = p[above, s] - q[above]
                if len(above) > least_ranks:  # ties with the last rank stay
                    near = more >= np.partition(more, -least_ranks)[-least_ranks]
                    above, more = above[near], more[near]
                lead[s] = sorted(lead[s] + [(-int(v), names[int(t)].as_py()) for t, v in zip(above, more)])[:least_ranks]
        a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
        by = [s for s, terms in enumerate(lead) for _ in terms]
        flat = [t for terms in lead for t in terms]
        names = pa.array([t.decode() for _, t in flat], pa.string())
        return pa.table(
            {
                "lang": pa.array([lang] * (len(a) + len(by)), pa.string()),
                "source": pa.concat_arrays([sources.take(pa.array(a)), sources.take(pa.array(by, pa.int64()))]),
                "part": pa.array(["pair"] * len(a) + ["term"] * len(by), pa.string()),
                "item": pa.concat_arrays([sources.take(pa.array(b)), names]),
                "value": pa.array(np.concatenate([apart[a, b], np.array([-v for v, _ in flat], np.int64)]), pa.int64()),
            }
        )

    return run


def source_divergence(docs: DataFrame, least: int = 30, ranks: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how the term shares of sources differ, for ``docs(text, lang, source)``.

    A language keeps the V terms that at least ``least`` of its documents hold. A group (lang, source)
    and a language as a whole give a kept term the share 1 + floor(10**9 * (count + 5) / (N + 5 V)),
    N being all their occurrences of kept terms. Part ``pair`` has every other source of the language
    with the sum of absolute differences, part ``term`` the ``ranks`` terms of the group by which its
    share is above the language's. Ranks go by value downwards, then by item.

    A row is a document: repeated rows count as often. Null texts, languages and sources are empty.
    Groups without terms take part; a language without kept terms has pairs of value 0. An empty
    table gives no rows. Work and result grow with the square of the sources of a language.
    Other columns are not read.
    """
    table = term_table(docs)
    kept = cut(kept_terms(table, least))
    n_terms = kept.count()
    counted = table.select("lang", "terms", "sources", "of_source", "of_term", "n").mapInArrow(_counts(Sieve(kept, "term")), "lang string, term binary, source string, n long")
    counts = cut(counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n")).join(kept, ["lang", "term"], "left_semi"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    groups = table.select("lang", F.explode("sources").alias("source")).distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
    blocks = max(1, -(-n_terms // TERMS))
    dealt = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    placed = counts.withColumn("block", (F.crc32("term") % blocks).cast("int"))
    found = cut(placed.groupBy("lang", "block").cogroup(dealt.groupBy("lang", "block")).applyInArrow(_compare(ranks), GROUP))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    lead = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(lead)
