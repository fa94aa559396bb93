"""Repeated passages: byte spans that also occur in an earlier document, by suffix arrays.

Documents are cut where the smallest hash of a 16-byte gram in the 50-byte window changes. Equal
windows have equal smallest hashes, so all copies of a window lie in pieces with one key. Keys of a
single document cannot repeat; pieces of the other keys, each distinct one once, are sorted in
suffix arrays bucket by bucket. Arrays are built in two stages: suffixes smaller than their
successors are sorted directly, the others are induced by scanning buckets. Neighbours in the
array that share a whole window are copies, and the smallest document among them keeps it. Pieces of
a key with more than ``HEAVY`` bytes of different pieces are cut into single windows, dealt by their
whole content, which need no sorting: equal windows are the same string.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.store import cut, shared_folder, written
from nodeledger.llm.wordhash import _BASE, _CODE, _INVERSE, mix, powers, text_buffers

GRAM = 16
#: Bytes of documents handled at a time, and per bucket of keys.
CHUNK, BUCKET = 1 << 21, 1 << 22
#: Windows whose keys are worked out together.
SLAB = 1 << 15
#: Bytes of pieces under one key, equal ones once for each chunk, above which the key is split.
HEAVY = 1 << 21
#: Places of the sieve of heavy keys, and salts of groups of whole copies.
SIEVE, SALTS = 1 << 20, 16
#: Keys have so many bits where they are only compared for being shared.
_SHORT = np.uint64(48)


# --- suffix array -------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one big-endian number, zeros after the end."""
    padded = np.concatenate([text, np.zeros(8 + 64, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + 64, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(out)]
    return out


def _direct(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` bytes there."""
    last = -(-depth // 8)
    order = at[np.lexsort((words[at + 8], words[at]))] if last > 1 else at[np.argsort(words[at], kind="stable")]
    for k in range(2, last, 2):
        same = np.zeros(len(order), bool)
        same[1:] = True
        for j in range(k):
            w = words[order + 8 * j]
            same[1:] &= w[1:] == w[:-1]
        tied = same.copy()
        tied[:-1] |= same[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(~same)[where]
        part = order[where]
        order[where] = part[np.lexsort((words[part + 8 * (k + 1)], words[part + 8 * k], group))]
    return order


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, words): places of ``text`` sorted by the suffixes there, up to ``depth`` bytes.

    Suffixes that agree in ``depth`` bytes come in any order.
    """
    n, words = len(text), _words(text)
    if not n:
        return np.zeros(0, np.int64), words
    # a suffix is smaller than its successor if the first differing byte after it is larger
    step = np.sign(np.diff(text.astype(np.int16), append=-1))
    turn = np.where(step != 0, np.arange(n), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    smaller = step[np.minimum(turn, n - 1)] > 0
    direct = _direct(np.flatnonzero(smaller), words, depth)
    first = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        found = []
        new = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(new):
            found.append(new)
            before = new[new > 0] - 1
            new = before[text[before] == c]
        bucket = np.concatenate([*found, direct[first[c] : first[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        letter = text[before]
        before, letter = before[letter > c], letter[letter > c]
        by_letter = np.argsort(letter, kind="stable")
        before, letter = before[by_letter], letter[by_letter]
        for part in np.split(before, np.flatnonzero(np.diff(letter)) + 1) if len(before) else []:
            induced[text[part[0]]].append(part)
    return np.concatenate(out), words


def neighbours_share(order: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of each place's suffix with the one before it has ``length`` bytes."""
    share = np.zeros(len(order), bool)
    share[1:] = True
    for at in sorted({*range(0, length - 7, 8), length - 8}):
        w = words[order + at]
        share[1:] &= w[1:] == w[:-1]
    return share


# --- pieces -------------------------------------------------------------------------------------


@dataclass
class Pieces:
    """Pieces of texts: the text of each, its places in all bytes, its key, and sums for hashes of spans."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    total: np.ndarray

    def content(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A value for the bytes of each span, for dealing and estimates; equal spans have equal ones."""
        return mix((self.total[end] - self.total[start]) * powers(_INVERSE, len(self.total))[start], 63)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Pieces:
    """The pieces of texts; a window lies in one piece, equal ones under one key."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * powers(_BASE, len(data)), out=total[1:])
    n = len(data) - length + 1
    if n <= 0:
        return Pieces(*(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64), total)
    key = _smallest_grams(total, n, length)
    valid = np.ones(n, bool)
    # the last places of each text begin no window (before a short text lie the last places of another one)
    outside = (offsets[1:, None] - np.arange(1, length)).ravel()
    valid[outside[(outside >= 0) & (outside < n)]] = False
    change = key[1:] != key[:-1]
    first = np.flatnonzero(valid & np.append(True, change | ~valid[:-1]))
    last = np.flatnonzero(valid & np.append(change | ~valid[1:], True))
    return Pieces(np.searchsorted(offsets, first, side="right") - 1, first, last + length, key[first], total)


def _smallest_grams(total: np.ndarray, n: int, length: int) -> np.ndarray:
    """The smallest gram hash of each of ``n`` windows, from prefix sums; in slabs that fit a processor's cache."""
    inverse, out, width = powers(_INVERSE, len(total)), np.empty(n, np.uint64), length - GRAM + 1
    for a in range(0, n, SLAB):
        b = min(a + SLAB, n)
        key = total[a + GRAM : b + width - 1 + GRAM] - total[a : b + width - 1]
        key *= inverse[a : b + width - 1]
        key ^= key >> np.uint64(32)
        key *= np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        done = 1
        while done * 2 <= width:
            key, done = np.minimum(key[:-done], key[done:]), done * 2
        np.minimum(key[: b - a], key[width - done : width - done + b - a], out=out[a:b])
    return out


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _keys(length: int, buckets: int):
    """Rows for finding shared keys: keys of one document here by bucket, the others with their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, b, data, offsets in _chunks(batch.column(1)):
                found = pieces(data, offsets, length)
                key = found.key >> (np.uint64(64) - _SHORT)
                doc = ids[a:b][found.text]
                # equal pieces go on once for each chunk, so only one of them counts
                size = np.zeros(len(key), np.int64)
                once = np.unique(found.content(found.start, found.end), return_index=True)[1]
                size[once] = (found.end - found.start)[once]
                order = np.lexsort((doc, key))
                key, doc, size = key[order], doc[order], size[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                size = np.add.reduceat(size, np.flatnonzero(new)) if len(key) else size
                key, doc = key[new], doc[new]
                first = np.ones(len(key), bool)
                first[1:] = key[1:] != key[:-1]
                edge = first | np.append(first[1:], True)[: len(first)]
                lonely = first & np.append(first[1:], True)[: len(first)]
                # a key of several documents here is shared; of those the first and the last go on for others
                bucket = (key[edge] % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                # the first entry of a key carries the bytes of all its different pieces here
                weight = np.zeros(len(key), np.int64)
                if len(key):
                    weight[first] = np.add.reduceat(size, np.flatnonzero(first))
                k, d, w, bucket = key[edge][by], doc[edge][by], weight[edge][by], bucket[by]
                cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))[: len(bucket)], len(bucket))
                rows = [(int(bucket[i]), False, k[i:j], d[i:j], w[i:j]) for i, j in zip(cuts[:-1], cuts[1:])] if len(k) else []
                if (~lonely).any():
                    rows.append((int(doc[0]) % buckets, True, key[~lonely], doc[~lonely], np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_())] + [pa.array([_packed(*r[2:]) for r in rows], pa.binary())],
                    names=["bucket", "known", "packed"],
                )

    return run


def _packed(key: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> bytes:
    """Keys in 6 bytes, documents in 4 where they lie close together, else in 8, weights in one: 8 times the binary logarithm, rounded up."""
    low = int(doc.min())
    kind = "<u4" if int(doc.max()) - low < 2**32 else "<u8"
    head = np.array([len(key), low, 4 if kind == "<u4" else 8], "<i8").tobytes()
    scaled = np.ceil(8 * np.log2(weight + 1)).astype(np.uint8).tobytes()
    return head + key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + (doc - low).astype(kind).tobytes() + scaled


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, low, size = np.frombuffer(packed, "<i8", 3).tolist()
    key = np.zeros((n, 8), np.uint8)
    key[:, :6] = np.frombuffer(packed, np.uint8, 6 * n, 24).reshape(n, 6)
    weight = np.exp2(np.frombuffer(packed, np.uint8, -1, 24 + (6 + size) * n) / 8) - 1
    return key.view("<u8").ravel(), np.frombuffer(packed, f"<u{size}", n, 24 + 6 * n).astype(np.int64) + low, weight


def _shared(group: pa.Table) -> pa.Table:
    """(doc_id, key) for the keys that more than one document has, and (null, key) for the heavy keys."""
    known = group.column("known").to_pylist()
    parts = [_unpacked(p) for p in group.column("packed").to_pylist()]
    out = [p[:2] for p, k in zip(parts, known) if k]
    heavy = np.zeros(0, np.uint64)
    rest = [p for p, k in zip(parts, known) if not k]
    if rest:
        key, doc, weight = (np.concatenate(x) for x in zip(*rest))
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        heavy = key[new][np.add.reduceat(weight[order], new) > HEAVY]
        last = np.append(new[1:], len(key)) - 1
        several = np.repeat(doc[new] < doc[last], last - new + 1)
        out.append((key[several], doc[several]))
    key, doc = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    none = pa.nulls(len(heavy), pa.int64())
    return pa.table({"doc_id": pa.chunked_array([pa.array(doc), none]), "key": pa.chunked_array([pa.array(key.astype(np.int64)), pa.array(heavy.astype(np.int64))])})


def _same(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each of the strings that follow each other in ``data``, equal for equal ones only."""
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data)])
    return strings.dictionary_encode().indices.to_numpy().astype(np.int64)


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans one after another, and where each begins and the last ends."""
    at = np.concatenate([[0], np.cumsum(size)])
    out, first = np.empty(at[-1], np.uint8), 0
    while first < len(size):  # positions take eight times the bytes: not all at once
        last = max(int(np.searchsorted(at, at[first] + CHUNK, side="right")) - 1, first + 1)
        within = np.arange(at[last] - at[first]) + np.repeat(start[first:last] - (at[first:last] - at[first]), size[first:last])
        out[at[first] : at[last]] = data[within]
        first = last
    return out, at


def _smallest(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by code and document, first place of each code in it, smallest document of each code)."""
    order = np.lexsort((doc, code))
    first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))[: len(code)]
    return order, first, doc[order][first]


def _joined(doc: np.ndarray, mark: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of documents with those that overlap or touch put together."""
    if not len(doc):
        return doc, mark, a, b
    order = np.lexsort((a, mark, doc))
    doc, mark, a, b = doc[order], mark[order], a[order], b[order]
    other = np.append(True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]))
    # the furthest end so far within a document: documents lie apart by more than any end
    apart = np.cumsum(other) * (int(b.max()) + 1)
    reach = np.maximum.accumulate(b + apart)
    first = np.flatnonzero(other | np.append(True, (a + apart)[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], mark[first], a[first], (reach - apart)[last]


def _lost(doc: np.ndarray, mark: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    return np.stack([doc, mark, a, b]).astype("<i8").tobytes()


def _cut_out(length: int, buckets: int, heavy: np.ndarray):
    """Distinct pieces with shared keys, by bucket, and what copies within the chunk already lose.

    Of several documents of a chunk with the same piece the smallest one goes on; the others lose
    the piece whatever other chunks hold. So a piece comes up once per chunk, however many
    documents have it. Pieces whose key the sieve ``heavy`` marks go on as single windows, each
    under a key of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            for a, b, data, offsets in _chunks(batch.column(1)):
                wanted = np.unique(batch.column(2).slice(a, b - a).flatten().to_numpy().astype(np.uint64))
                found = pieces(data, offsets, length)
                short = found.key >> (np.uint64(64) - _SHORT)
                at = np.minimum(np.searchsorted(wanted, short), max(len(wanted) - 1, 0))
                keep = wanted[at] == short if len(wanted) else np.zeros(len(short), bool)
                text, start, end, key = found.text[keep], found.start[keep], found.end[keep], found.key[keep]
                split = heavy[(short[keep] % np.uint64(len(heavy))).astype(np.int64)]
                if split.any():
                    many = np.where(split, end - start - length + 1, 1)
                    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    text, start, end, key, split = (np.repeat(x, many) for x in (text, start, end, key, split))
                    start = start + nth
                    end = np.where(split, start + length, end)
                    key[split] = found.content(start[split], end[split])
                doc, mark, here = ids[a:b][text], marks[a:b][text], start - offsets[text]
                raw, at = _gathered(data, start, end - start)
                code = _same(raw, at)
                del raw
                order, _, least = _smallest(code, doc)
                again = doc > least[code] if len(least) else np.zeros(0, bool)
                rows = []
                # the one document's pieces, also where it has one twice
                by = np.flatnonzero(~again)
                bucket = (mix(key[by], 62) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                by, bucket = by[order], bucket[order]
                raw, at = _gathered(data, start[by], (end - start)[by])
                edges = np.flatnonzero(np.append(True, np.diff(bucket) != 0))[: len(by)]
                for i, j in zip(edges.tolist(), np.append(edges[1:], len(by)).tolist()):
                    part = by[i:j]
                    long = np.stack([doc[part], mark[part]]).astype("<i8").tobytes()
                    short = np.stack([here[part], (end - start)[part], (key[part] & np.uint64(0xFFFFFFFF)).astype(np.int64)]).astype("<u4").tobytes()
                    rows.append((int(bucket[i]), False, j - i, zlib.compress(long + short + raw[at[i] : at[j]].tobytes(), 1)))
                if again.any():
                    runs = _joined(doc[again], mark[again], here[again], (here + end - start)[again])
                    rows.append((int(runs[0][0]) % buckets, True, len(runs[0]), zlib.compress(_lost(*runs), 1)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.bool_(), pa.int64(), pa.binary()))], names=["bucket", "known", "n", "packed"])

    return run


def _windows_owned_before(text: np.ndarray, begin: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, a, b): runs within pieces of windows that a piece of a smaller document also has."""
    order, words = suffix_array(text, length)
    owner = np.repeat(np.arange(len(size)), size)
    order = order[order - begin[owner[order]] + length <= size[owner[order]]]
    start = np.flatnonzero(~neighbours_share(order, words, length))
    smallest = np.empty(len(text), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(doc[owner[order]], start), np.diff(np.append(start, len(order))))
    place = np.sort(order)
    place = place[smallest[place] < doc[owner[place]]]
    # windows side by side in a piece are one run
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (owner[place[1:]] != owner[place[:-1]])
    first = np.flatnonzero(new)
    last = (np.append(first[1:], len(place)) - 1)[: len(first)]
    who = owner[place[first]]
    return who, place[first] - begin[who], place[last] - begin[who] + length


def _first_owner(length: int):
    """Runs (doc_id, mark, a, b) that a document loses to smaller ones.

    Equal pieces are one string for the suffix array, which holds those that share a key with others.
    """

    def run(group: pa.Table) -> pa.Table:
        out, longs, shorts, raw = [], [], [], []
        for known, n, packed in zip(*(group.column(c).to_pylist() for c in ("known", "n", "packed"))):
            packed = zlib.decompress(packed)
            if known:
                out.append(np.frombuffer(packed, "<i8", 4 * n).reshape(4, n))
                continue
            longs.append(np.frombuffer(packed, "<i8", 2 * n).reshape(2, n))
            shorts.append(np.frombuffer(packed, "<u4", 3 * n, 16 * n).reshape(3, n))
            raw.append(packed[28 * n :])
        if raw:
            doc, mark = np.concatenate(longs, axis=1)
            start, size, tag = np.concatenate(shorts, axis=1).astype(np.int64)
            data = np.frombuffer(b"".join(raw), np.uint8)
            del longs, shorts, raw
            at = np.concatenate([[0], np.cumsum(size)])
            code = _same(data, at)
            order, first, least = _smallest(code, doc)
            gone = doc > least[code]
            out.append(np.stack([doc[gone], mark[gone], start[gone], (start + size)[gone]]))
            one = order[first]  # a row of each distinct piece, by code
            by_tag = np.unique(tag[one], return_inverse=True, return_counts=True)
            several = np.flatnonzero(by_tag[2][by_tag[1]] > 1)
            if len(several):
                text, begin = _gathered(data, at[:-1][one[several]], size[one[several]])
                who, a, b = _windows_owned_before(text, begin[:-1], size[one[several]], least[several], length)
                # for every place where the piece's smallest document has it
                kept = ~gone[order]
                count = np.bincount(code, ~gone, len(first)).astype(np.int64)
                holders, at_code = order[kept], np.cumsum(count) - count
                which = several[who]
                times = count[which]
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row = holders[np.repeat(at_code[which], times) + nth]
                out.append(np.stack([doc[row], mark[row], start[row] + np.repeat(a, times), start[row] + np.repeat(b, times)]))
        runs = _joined(*(np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)))
        return pa.table(dict(zip(("doc_id", "mark", "a", "b"), runs)))

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        kept, removed, spans = [], [], []
        for i, runs in enumerate(batch.column(2).to_pylist()):
            text, out, at, gone, n = texts[i].as_py(), [], 0, 0, 0
            end = -1
            for r in sorted((r["a"], r["b"]) for r in runs or ()):
                if r[0] > end:
                    n += 1
                    out.append(text[max(at, 0) : r[0]])
                start = max(r[0], end)
                if r[1] > end:
                    gone += r[1] - start
                    end = at = r[1]
            out.append(text[max(at, 0) :])
            kept.append(b"".join(out))
            removed.append(gone)
            spans.append(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], names=["doc_id", "kept", "n_removed", "n_spans"])


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without what an earlier document has.

    A byte goes if some ``length`` bytes around it also begin in a document with a smaller doc_id,
    judged on the texts as they are. ``n_spans`` counts the removed runs, ``kept`` holds the other
    bytes. ``length`` is at least 24.

    Null and empty texts and those shorter than ``length`` keep all. Rows that share an id are
    texts of one document: each is judged, and they don't take from each other. A row without an id
    keeps all and takes nothing. Repeated rows give as many rows. An empty table gives an empty
    result. Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    own = F.struct("mark", F.xxhash64(F.lit(1), "text").alias("b"), F.octet_length("text").cast("long").alias("n_bytes"))
    each = cut(texts.where("doc_id is not null").select("doc_id", own.alias("print")).distinct())
    total = each.agg(F.sum("print.n_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET))
    # a copy of a whole earlier document goes as a whole and is not compared any further; a group
    # of copies may hold a third of all rows, so its members meet its first one under several salts
    earliest = each.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    earliest = earliest.select("print", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = each.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(earliest, ["print", "salt"], "left")
    states = copies.groupBy("doc_id").agg(
        (F.min("print") != F.max("print")).alias("several"), F.collect_set(F.when(F.col("doc_id") > F.col("rep"), F.col("print.mark"))).alias("copies")
    )
    marked = texts.join(states, "doc_id", "left").select(
        "doc_id", "text", F.when(F.col("several"), F.col("mark")).otherwise(F.lit(0)).alias("mark"),
        F.coalesce(F.array_contains("copies", F.col("mark")), F.lit(False)).alias("copy"),
    )
    stored = _bucketed(marked)

    rows = stored.where(F.col("doc_id").isNotNull() & ~F.col("copy") & (F.octet_length("text") >= length))
    found = rows.select("doc_id", "text").mapInArrow(_keys(length, buckets), "bucket long, known boolean, packed binary").groupBy("bucket").applyInArrow(_shared, "doc_id long, key long")
    found = written(found, "keys")
    # a sieve of heavy keys: of fixed size, however many there are; a key it marks for another one is split too
    sieve = np.zeros(SIEVE, bool)
    sieve[[r["at"] for r in found.where("doc_id is null").select(F.pmod("key", F.lit(SIEVE)).alias("at")).distinct().collect()]] = True
    shared = found.where("doc_id is not null").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    packed = rows.join(shared, "doc_id").select("doc_id", "text", "keys", "mark").mapInArrow(_cut_out(length, buckets, sieve), "bucket long, known boolean, n long, packed binary")
    lost = packed.groupBy("bucket").applyInArrow(_first_owner(length), "doc_id long, mark long, a long, b long")
    runs = lost.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "a", "b")).alias("runs"))
    size = F.octet_length("text").cast("long")
    everything = F.array(F.struct(F.col("mark"), F.lit(0).cast("long").alias("a"), size.alias("b")))
    mine = F.filter("runs", lambda r: r["mark"] == F.col("mark"))
    lose = F.when(F.col("copy") & (size >= length), everything).when(~F.col("copy"), mine)
    cleaned = stored.join(runs, "doc_id", "left").select("doc_id", "text", lose.alias("runs")).mapInArrow(_remove, "doc_id long, kept binary, n_removed long, n_spans long")
    return cleaned.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"), "n_removed", "n_spans", "kept")


def _bucketed(rows: DataFrame) -> DataFrame:
    """The rows as a table bucketed by doc_id in the shared folder: joins on it move only the other side."""
    spark = rows.sparkSession
    name = f"llm_texts_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}")
    writer.bucketBy(parts, "doc_id").saveAsTable(name)
    return spark.table(name)
