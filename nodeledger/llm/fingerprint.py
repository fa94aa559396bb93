"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for a text of bytes c[0], c[1], ..., the sums of c[j] * b**j below each place,
modulo the prime 2**31 - 1, for two bases. The hash of any span is a difference of two entries, so
equality of spans takes constant time and the longest common extension of two places a binary
search. A fingerprint is the hash of the whole text and, for each of ``SLOTS`` classes of window
hashes, the smallest one; the share of equal slots estimates how alike two texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.wordhash import mix

PRIME = np.uint64(2**31 - 1)
BASES = (1_103_515_245, 1_566_083_941)
#: Bytes in a window, and slots of a fingerprint.
WINDOW, SLOTS = 24, 64
_EMPTY = np.iinfo(np.uint64).max
_powers: dict[int, np.ndarray] = {}


def fold(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder modulo the Mersenne prime, without division."""
    high = x >> np.uint64(31)
    high += x & PRIME
    return high


def reduced(x: np.ndarray) -> np.ndarray:
    x = fold(fold(x))
    x[x >= PRIME] -= PRIME
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, reduced(have * np.uint64(pow(base, len(have), int(PRIME))))])
    _powers[base] = have
    return have[:n]


class Prefixes:
    """Prefix hashes of one text, for one base."""

    #: Sums are carried on modulo the prime after so many bytes; until then they stay below 2**62.
    STEP = 1 << 23
    #: A multiple of the prime above any sum, so that differences aren't negative.
    LIFT = PRIME << np.uint64(32)

    def __init__(self, data: np.ndarray, base: int = BASES[0]) -> None:
        self.base, self.sums = base, np.zeros(len(data) + 1, np.uint64)
        power = powers(base, max(len(data), 1))
        for at in range(0, len(data), self.STEP):
            part = (data[at : at + self.STEP] + np.uint64(1)) * power[at : at + self.STEP]
            part[0] += self.sums[at] % PRIME
            np.cumsum(part, out=self.sums[at + 1 : at + 1 + len(part)])

    def spans(self, size: int) -> np.ndarray:
        """Hashes of all spans of one size, whatever their place."""
        n = len(self.sums) - size
        raw = self.sums[size:] - self.sums[:n]
        if len(self.sums) > self.STEP:
            raw += self.LIFT
        return reduced(fold(fold(raw)) * powers(pow(self.base, -1, int(PRIME)), len(self.sums))[:n])

    def whole(self) -> int:
        return int(self.sums[-1]) % int(PRIME)

    def span(self, start: int, size: int) -> int:
        raw = int(self.sums[start + size]) - int(self.sums[start])
        return raw * int(powers(pow(self.base, -1, int(PRIME)), len(self.sums))[start]) % int(PRIME)


class Text:
    """A text that answers span questions."""

    def __init__(self, text: str | bytes) -> None:
        data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
        self.size = len(data)
        self.prefixes = [Prefixes(data, b) for b in BASES]

    def same(self, start: int, other: Text, at: int, size: int) -> bool:
        """Whether the spans of ``size`` bytes at ``start`` here and ``at`` in ``other`` are equal."""
        return all(p.span(start, size) == q.span(at, size) for p, q in zip(self.prefixes, other.prefixes))

    def common_extension(self, start: int, other: Text, at: int) -> int:
        """The longest common extension of the two places in bytes, by binary search."""
        low, high = 0, min(self.size - start, other.size - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def sketch(self) -> np.ndarray:
        """The smallest window hash of each class; a shorter text is one window."""
        out = np.full(SLOTS, _EMPTY, np.uint64)
        if self.size:
            size = min(WINDOW, self.size)
            h = self.prefixes[0].spans(size)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            np.minimum.at(out, (h >> np.uint64(58)).astype(np.int64), h)
        return out

    def fingerprint(self) -> str:
        """Equal for equal texts: length and hashes of the whole, then 16 bits of each slot."""
        whole = "%08x%08x%08x" % (self.size % 2**32, *(p.whole() for p in self.prefixes))
        slots = self.sketch()
        short = mix(slots, 3) & np.uint64(0xFFFF)
        return whole + "".join("----" if s == _EMPTY else "%04x" % v for s, v in zip(slots.tolist(), short.tolist()))


_HEAD = 24


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, else the share of equal slots among those that either one fills."""
    if a == b:
        return 1.0
    pairs = [(a[i : i + 4], b[i : i + 4]) for i in range(_HEAD, _HEAD + 4 * SLOTS, 4)]
    used = [x == y for x, y in pairs if x != "----" or y != "----"]
    return sum(used) / len(used) if used else 0.0


def _views(texts: pa.Array) -> Iterator[bytes]:
    for t in pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary()):
        yield t.as_py()


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, fingerprint) and the columns ``keep`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have the fingerprint of the empty text. A null doc_id stays null and
    repeated rows give as many rows. Other columns are not read.
    """
    kinds = dict(docs.dtypes)
    schema = "doc_id long, fingerprint string" + "".join(f", {c} {kinds[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([Text(t).fingerprint() for t in _views(batch.column(1))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints, *batch.columns[2:]], names=["doc_id", "fingerprint", *keep])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep).mapInArrow(run, schema)


def _first_ids(ids: DataFrame) -> np.ndarray:
    """The smallest id of each of as many even ranges of ids as there are shuffle partitions.

    One number per partition comes to the driver; equal ids are in one range.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("first"))
    return np.sort(ranged.select("first").toArrow().column("first").to_numpy())


def with_edits(docs: DataFrame) -> DataFrame:
    """Each document, its edited text, and how alike fingerprints are.

    (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next, common_bytes)
    for every row of ``docs(doc_id, text)``. The edit replaces the last quarter of the code points
    by the first as many of the next document in ascending doc_id, the first one following the
    last. ``common_bytes`` is the longest common extension of the beginnings of text and edit.

    Texts are dealt to ranges of ids, once and compressed, and come down from the highest id, so that
    a text's next document is the one before it in the stream. The first document of a range
    is also sent ahead of the range below it.

    Rows that share an id have the same next document; of several texts of that one any
    serves, always the same one. A row without an id has no next document: nothing is put in, near_next is 0.
    An empty table gives no rows. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    first = _first_ids(texts.where("doc_id is not null").select("doc_id"))
    dealt = texts.mapInArrow(_pack(first), "part int, ahead boolean, doc_id long, packed binary")
    ranges = dealt.repartitionById(max(len(first), 1), "part")
    ordered = ranges.sortWithinPartitions("part", F.desc("ahead"), F.desc("doc_id"), "packed")
    return ordered.mapInArrow(_compare, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_bytes long")


def _pack(first: np.ndarray):
    """Each text with the range of its id; a range's first one for the range below too, which the lowest is to the highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(batch.column(0), 0).to_numpy()
            part = np.maximum(np.searchsorted(first, ids, side="right") - 1, 0)
            part[none] = np.arange(none.sum()) % max(len(first), 1)
            packed = [codec.compress(t) for t in _views(batch.column(1))]
            begins = np.flatnonzero(~none & (first[part] == ids)) if len(first) else np.zeros(0, np.int64)
            rows = np.append(np.arange(len(ids)), begins)
            ahead = np.append(np.zeros(len(ids), bool), np.ones(len(begins), bool))
            part = np.append(part, (part[begins] - 1) % max(len(first), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(ahead), batch.column(0).take(pa.array(rows)), pa.array([packed[i] for i in rows], pa.binary())],
                names=["part", "ahead", "doc_id", "packed"],
            )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each text with its edit and with the text of the next id, which came before it."""
    unpack = zstandard.ZstdDecompressor()
    part_now, id_now = None, None
    # (text, fingerprint) of the next document, and of the first row of the present id
    following, current = ("", None), ("", None)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    for batch in batches:
        for i in range(0, len(batch), 500):
            out = []
            for part, ahead, doc_id, packed in zip(*(c.to_pylist() for c in batch.slice(i, 500).columns)):
                if part != part_now:
                    part_now, id_now, current, following = part, None, ("", None), ("", None)
                if ahead and current[1] is not None:
                    continue
                raw = unpack.decompress(packed)
                text, a = raw.decode(), Text(raw)
                own = a.fingerprint()
                if ahead:
                    current = (text, own)
                    continue
                if doc_id is None:
                    following = ("", None)
                elif doc_id != id_now:
                    id_now, following, current = doc_id, current, (text, own)
                quarter = len(text) // 4
                edited = text[: len(text) - quarter] + following[0][:quarter]
                b = Text(edited)
                new = b.fingerprint()
                near_next = likeness(own, following[1]) if following[1] else 0.0
                out.append((doc_id, len(text), edited, own, new, likeness(own, new), near_next, a.common_extension(0, b, 0)))
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_bytes"])
