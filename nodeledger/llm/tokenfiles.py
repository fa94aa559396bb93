"""Token ids on disk: frequency-ranked, variable-length, with control bytes of their own.

A file row is a document: ``control`` holds two bits per id (its length in bytes less one, four ids
a byte, lowest bits first) and ``data`` the little-endian bytes of the ids' ranks by frequency, so
that common ids take one byte. The rows lie in Parquet files in ascending order of doc_id, written
and committed by Spark, with the ids before a row in its file; ``ranks`` beside them maps ranks to
ids. Decoding looks lengths up in a table by control byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nodeledger.llm.store import written
from nodeledger.llm.wordhash import Block, blocks

#: Words and pieces of words remembered per worker.
REMEMBERED = 400_000

# How the tokenizer file cuts lower-cased words of the first 256 characters.
_L, _N = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
#: Stands behind each word when many are cut at once.
END = "\n"
PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^{_L}{_N}{END}]+|{END}")


class Memory:
    """Id sequences of words, by word. When it is full, words met only once so far are forgotten."""

    def __init__(self, words: tuple[str, ...] = (), sizes: np.ndarray | None = None, ids: np.ndarray | None = None) -> None:
        self.number: dict[str, int] = dict(zip(words, range(len(words))))
        self.size = np.zeros(0, np.int64) if sizes is None else sizes
        self.ids = np.zeros(0, np.int32) if ids is None else ids
        self.met = np.zeros(len(words), np.int64)

    def add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.size, self.ids = np.concatenate([self.size, sizes]), np.concatenate([self.ids, ids.astype(np.int32)])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])

    def room(self, distinct: set[str]) -> set[str]:
        """Which of the words are new; before that, room is made for them if needed."""
        new = distinct.difference(self.number)
        if len(self.number) + len(new) <= REMEMBERED:
            return new
        keep = np.flatnonzero(self.met > 1)
        keep = keep[np.argsort(-self.met[keep], kind="stable")][: REMEMBERED // 2]
        words = [*self.number]
        size = self.size[keep]
        start = np.concatenate([[0], np.cumsum(self.size)])[keep]
        self.__init__(tuple(words[i] for i in keep), size, self.ids[_spans(start, size)])
        return distinct.difference(self.number)

    def numbers(self, words: list[str]) -> np.ndarray:
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.met += np.bincount(number, minlength=len(self.met))
        return number


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the spans one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def _lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The words of a block in UTF-8 with ``END`` behind each."""
    size = ends - starts + 1
    out = data[np.minimum(_spans(starts, size), max(len(data) - 1, 0))]
    out[np.cumsum(size) - 1] = ord(END)
    return out.tobytes().decode()


class WordMemory:
    """Id sequences of words by the words' 64-bit hashes, in an open-addressing table."""

    SLOTS, PROBES = 1 << 21, 16

    def __init__(self) -> None:
        self.key, self.at = np.zeros(self.SLOTS, np.uint64), np.zeros(self.SLOTS, np.int32)
        self.hash, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it isn't known."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for probe in range(self.PROBES):
            slot = ((h[left] + np.uint64(probe)) % np.uint64(self.SLOTS)).astype(np.int64)
            there = self.key[slot]
            hit = there == h[left]
            out[left[hit]] = self.at[slot[hit]]
            left = left[~hit & (there != 0)]
            if not len(left):
                break
        return out

    def add(self, h: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        if len(self.hash) + len(h) > REMEMBERED and len(self.hash):
            keep = np.flatnonzero(self.met > 1)
            keep = keep[np.argsort(-self.met[keep], kind="stable")][: REMEMBERED // 2]
            kept = self.hash[keep], self.size[keep], self.ids[_spans((np.cumsum(self.size) - self.size)[keep], self.size[keep])]
            self.__init__()
            self._put(*kept)
        self._put(h, sizes, ids)

    def _put(self, h: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        number = len(self.hash) + np.arange(len(h))
        self.hash, self.met = np.concatenate([self.hash, h]), np.concatenate([self.met, np.zeros(len(h), np.int64)])
        self.size, self.ids = np.concatenate([self.size, sizes]), np.concatenate([self.ids, ids.astype(np.int32)])
        left = np.arange(len(h))
        for probe in range(self.PROBES):  # a word that finds no slot is learned again when it comes up
            slot = ((h[left] + np.uint64(probe)) % np.uint64(self.SLOTS)).astype(np.int64)
            free = self.key[slot] == 0
            self.key[slot[free]] = h[left[free]]
            mine = self.key[slot] == h[left]
            self.at[slot[mine]] = number[left[mine]]
            left = left[~mine]


class WordTokenizer:
    """A tokenizer file whose words end at white space; the library sees each distinct piece once.

    Texts are cut at ASCII white space, where this kind of tokenizer always cuts. Words are told
    apart by 64-bit hashes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.vocabulary = 1 + max(self.library.get_vocab(with_added_tokens=True).values())
        self.last = np.zeros(self.vocabulary, bool)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.last[i] = token.endswith("</w>")
        self.words, self.pieces = WordMemory(), Memory()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _learn_pieces(self, pieces: list[str]) -> None:
        for i in range(0, len(pieces), 2000):
            part = pieces[i : i + 2000]
            ids = self._library([" ".join(part)])[0]
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part):
                self.pieces.add(part, np.diff(ends, prepend=0), ids)
            else:
                each = self._library(part)
                self.pieces.add(part, np.array([*map(len, each)]), np.concatenate(each))

    def _unusual(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words that the library gets whole: characters beyond the first 256, separators inside
        what is a word here, special tokens."""
        data = block.data
        after = np.append(data[1:], 0)
        marked = (data >= 0xC4) | ((data >= 0x1C) & (data <= 0x1F)) | ((data == 0xC2) & ((after == 0x85) | (after == 0xA0)))
        before = np.concatenate([[0], np.cumsum(marked)])
        odd = before[ends] > before[starts]
        opening = np.isin(data, np.unique([s.encode()[0] for s in self.special]).astype(np.uint8))
        before = np.concatenate([[0], np.cumsum(opening)])
        for i in np.flatnonzero((before[ends] > before[starts]) & ~odd).tolist():
            word = data[starts[i] : ends[i]].tobytes().decode()
            odd[i] = any(s in word for s in self.special)
        return odd

    def _encode_words(self, block: Block, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each of the words ``which`` of a block has, all ids)."""
        starts, ends = block.starts[which], block.ends[which]
        odd = self._unusual(block, starts, ends)
        plain, odd = np.flatnonzero(~odd), np.flatnonzero(odd)
        pieces = PIECES.findall(_lines(block.data, starts[plain], ends[plain]).lower())
        new = self.pieces.room({*pieces, END})
        self._learn_pieces([*new - {END}])
        if END in new:
            self.pieces.add([END], np.zeros(1, np.int64), np.zeros(0, np.int32))
        number = self.pieces.numbers(pieces)
        size = self.pieces.size[number]
        flat = self.pieces.ids[_spans((np.cumsum(self.pieces.size) - self.pieces.size)[number], size)]
        of_plain = np.diff(np.cumsum(size)[number == self.pieces.number[END]], prepend=0)
        if not len(odd):
            return of_plain, flat
        each = self._library([block.data[a:b].tobytes().decode() for a, b in zip(starts[odd].tolist(), ends[odd].tolist())])
        sizes = np.zeros(len(which), np.int64)
        sizes[plain], sizes[odd] = of_plain, [*map(len, each)]
        at, ids = np.cumsum(sizes) - sizes, np.zeros(sizes.sum(), np.int32)
        ids[_spans(at[plain], of_plain)] = flat
        ids[_spans(at[odd], sizes[odd])] = np.concatenate(each)
        return sizes, ids

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a block, where each text begins in them and where the last ends)."""
        h = block.hashes(fold_case=False, exact_long=True)
        number = self.words.find(h)
        new = np.flatnonzero(number < 0)
        ids, sizes = self.words.ids, self.words.size
        if len(new):
            fresh, first = np.unique(h[new], return_index=True)
            new_sizes, new_ids = self._encode_words(block, new[first])
            # what is known and what is new, put together for this block; the memory may drop some of it
            number[new] = len(sizes) + np.searchsorted(fresh, h[new])
            ids, sizes = np.concatenate([ids, new_ids.astype(np.int32)]), np.concatenate([sizes, new_sizes])
        known = len(self.words.met)
        if known:
            self.words.met += np.bincount(number[number < known], minlength=known)
        if len(new):
            self.words.add(fresh, new_sizes, new_ids)
        size = sizes[number]
        flat = ids[_spans((np.cumsum(sizes) - sizes)[number], size)]
        return flat, np.concatenate([[0], np.cumsum(size)])[block.word_at]


@lru_cache(maxsize=2)
def loaded(path: str) -> WordTokenizer:
    return WordTokenizer(path)


# --- the code -----------------------------------------------------------------------------------

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Control and data bytes of documents with ``counts`` unsigned 32-bit values each, with offsets."""
    values = np.ascontiguousarray(values, "<u4")
    size = 1 + (values > 0xFF) + (values > 0xFFFF).astype(np.int64) + (values > 0xFFFFFF)
    lines = np.concatenate([[0], np.cumsum(-(-counts // 4))])
    codes = np.zeros(4 * lines[-1], np.uint8)
    codes[np.arange(len(values)) + np.repeat(4 * lines[:-1] - (np.cumsum(counts) - counts), counts)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    return (control, lines), (values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]], at)


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values of documents whose control and data bytes follow each other."""
    lines = -(-counts // 4)
    used = np.arange(counts.sum()) + np.repeat(4 * (np.cumsum(lines) - lines) - (np.cumsum(counts) - counts), counts)
    size = _LENGTHS[control].ravel()[used]
    at = np.cumsum(size) - size
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    out = padded[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > k)
        out[longer] |= padded[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the size of each entry."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8), np.diff(at)


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


# --- Spark --------------------------------------------------------------------------------------


def encode_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids): little-endian 16- or 32-bit ids, with ``end_id`` after each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(path)
        kind = "<u2" if tokenizer.vocabulary <= 1 << 16 else "<u4"
        for batch in batches:
            for block in blocks(batch.column(1)):
                flat, at = tokenizer.encode(block)
                # the end id goes in behind each text
                ids = np.insert(flat, at[1:], end_id).astype(kind).tobytes()
                where = ((at + np.arange(len(at))) * np.dtype(kind).itemsize).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), block.texts(), [None, pa.py_buffer(where), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.texts()), packed], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 1) -> None:
    """Write the ids of ``docs(doc_id, text)`` below ``folder`` in ascending order of doc_id.

    Null and empty texts have the end id only. A null doc_id comes first; rows that share a
    doc_id follow each other in the order of a hash of their ids, which splits a frequent doc_id over
    files. An empty table gives no rows. Other columns are not read.
    """
    vocabulary = loaded(path).vocabulary
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    encoded = written(encode_documents(docs, path, end_id), "ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(_bytes_of(batch.column(0))[0].view(kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    # at most one row per vocabulary entry comes to the driver
    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranks = [r["id"] for r in counts.orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame([(i, x) for i, x in enumerate(ranks)], "rank int, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(vocabulary, np.uint32)
    rank_of[ranks] = np.arange(len(ranks))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            raw, size = _bytes_of(batch.column(1))
            n = size // np.dtype(kind).itemsize
            control, data = pack(rank_of[raw.view(kind)], n)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            where = pa.array(np.full(len(n), part), pa.int32()), pa.array(starts, pa.int64())
            columns = [batch.column(0), pa.array(n, pa.int64()), _binary(*control), _binary(*data), *where]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "control", "data", "part", "before"])

    # ids are dealt to ranges as they are and coded there: the sample that finds the ranges runs no Python;
    # the hash splits the rows of a frequent doc_id over ranges
    turned = encoded.select("doc_id", F.xxhash64("ids").alias("turn"), "ids")
    ordered = turned.repartitionByRange("doc_id", "turn").sortWithinPartitions("doc_id", "turn", "ids").select("doc_id", "ids")
    placed = ordered.mapInArrow(place, "doc_id long, n_tokens long, control binary, data binary, part int, before long")
    placed.write.option("compression", "zstd").parquet(f"{folder}/documents")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian 32-bit numbers, ``start`` the ids before."""
    # one row per vocabulary entry
    ids = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], "<u4")
    rows = spark.read.schema("doc_id long, n_tokens long, control binary, data binary, part int, before long").parquet(f"{folder}/documents")
    # one row per file
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, n, control, data, part, before = batch.columns
            counts = n.to_numpy()
            values = ids[unpack(_bytes_of(control)[0], _bytes_of(data)[0], counts)]
            out = _binary(values.view(np.uint8), 4 * np.concatenate([[0], np.cumsum(counts)]))
            yield pa.RecordBatch.from_arrays([doc_id, n, out, part, before], names=["doc_id", "n_tokens", "ids", "part", "before"])

    decoded = rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, part int, before long")
    return decoded.join(F.broadcast(ahead), "part").select("doc_id", (F.col("before") + F.col("ahead")).alias("start"), "n_tokens", "ids")
