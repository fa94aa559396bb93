"""Byte-level BPE: encoding by segment trees over adjacent pair ranks, and decoding.

A word's leaves hold rank * width + position of the pair that begins there, so that the root of a
minimum tree is the leftmost pair of lowest rank. A merge changes at most three leaves, each
updated along its path to the root; encoding ends when the root is empty. Distinct words of a
batch are merged side by side, one numpy row each; long words have a tree of their own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.store import hand_back

# The pre-token pattern of this tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

# The same pattern spelled out for texts of the first 256 characters, for the faster engine.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
LATIN = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

#: Words up to this many bytes are merged side by side.
SIDE_BY_SIDE = 64
#: Texts of about so many characters are encoded at a time, and so many words are remembered.
BATCH_CHARS, REMEMBERED = 1 << 20, 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {}, 256
    for b in range(256):
        letters[b] = chr(b) if b in shown else chr(extra)
        extra += b not in shown
    return [letters[b] for b in range(256)]


class Bpe:
    """A tokenizer file of the byte-level BPE kind."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([vocabulary[c] for c in letters], np.int64)
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        self.rank = {(a, b): r for r, (a, b, _) in reversed([*enumerate(pairs)])}
        key = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], np.array([*self.rank.values()], np.int64)[order]
        self.result = np.array([c for _, _, c in pairs], np.int64)
        self.none = len(pairs)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.plain = regex.compile(PATTERN)
        self.forget()

    def forget(self) -> None:
        """Empty the memory of words: their numbers, and by number the sizes and places of their ids."""
        self.number: dict[str, int] = {}
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def plain_words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.plain.findall(text)
        return LATIN.findall(text)

    def words(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.plain_words(text)
        # a special token ends the text before it, also for the look-ahead of the pattern
        return [w for part in self.cut.split(text) for w in ([part] if part in self.special else self.plain_words(part))]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge_side_by_side(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words of up to ``SIDE_BY_SIDE`` bytes one after another, and how many each has."""
        width = 1
        while width < max(map(len, words)):
            width *= 2
        n, step = len(words), width + 2
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        inside = np.arange(width) < np.array([*map(len, words)])[:, None]
        # column 0 and the last one stand for what is before and after a word
        token = np.full((n, step), -1, np.int64)
        token[:, 1:-1] = np.where(inside, self.byte_id[data], -1)
        rank = self._rank(token[:, 1:-1], token[:, 2:])
        empty = self.none * width
        tree = np.full((n, 2 * width), empty, np.int32)
        tree[:, width:] = np.where(rank < self.none, rank * width + np.arange(width), empty)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        after = np.tile(np.minimum(np.arange(1, step + 1), step - 1).astype(np.int32), (n, 1)).ravel()
        before = np.tile(np.maximum(np.arange(-1, step - 1), 0).astype(np.int32), (n, 1)).ravel()
        token, tree = token.ravel(), tree.ravel()

        def put(root: np.ndarray, at: np.ndarray, rank: np.ndarray | None) -> None:
            node = at + width
            tree[root + node] = empty if rank is None else np.where(rank < self.none, rank * width + at, empty)
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                child = root + 2 * node
                tree[root + node] = np.minimum(tree[child], tree[child + 1])

        row = np.arange(n)
        while True:
            best = tree[row * (2 * width) + 1].astype(np.int64)
            go = best < empty
            row, best = row[go], best[go]
            if not len(row):
                break
            root, line = row * (2 * width), row * step
            at = best % width
            here = line + at + 1
            right = after[here]
            end = after[line + right]
            token[here], token[line + right] = self.result[best // width], -1
            after[here] = end
            before[line + end] = at + 1
            put(root, right - 1, None)
            put(root, at, self._rank(token[here], token[line + end]))
            left = before[here].astype(np.int64)
            has = left > 0
            line, root, left = line[has], root[has], left[has]
            put(root, left - 1, self._rank(token[line + left], token[here[has]]))
        token = token.reshape(n, step)
        return token[token >= 0], (token >= 0).sum(axis=1)

    def merge_alone(self, word: bytes) -> np.ndarray:
        """Token ids of one long word."""
        token = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n, width = len(token), 1
        while width < n:
            width *= 2
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        empty = self.none * width
        rank = self._rank(np.array(token[:-1]), np.array(token[1:]))
        leaves = np.full(width, empty, np.int64)
        leaves[: n - 1] = np.where(rank < self.none, rank * width + np.arange(n - 1), empty)
        levels = [leaves]
        while len(levels[0]) > 1:
            levels.insert(0, levels[0].reshape(-1, 2).min(axis=1))
        tree = [empty, *(x for level in levels for x in level.tolist())]

        def put(at: int, pair: tuple[int, int] | None) -> None:
            rank = self.rank.get(pair, self.none)
            node = at + width
            tree[node] = rank * width + at if rank < self.none else empty
            while node := node >> 1:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] < empty:
            at, rank = tree[1] % width, tree[1] // width
            right = after[at]
            end = after[right]
            token[at], token[right], after[at] = int(self.result[rank]), -1, end
            put(right, None)
            if end < n:
                before[end] = at
                put(at, (token[at], token[end]))
            else:
                put(at, None)
            if before[at] >= 0:
                put(before[at], (token[before[at]], token[at]))
        return np.array([t for t in token if t >= 0])

    def learn(self, words: set[str]) -> None:
        """Remember the ids of new words."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            b = w.encode()
            groups.setdefault(0 if len(b) > SIDE_BY_SIDE or w in self.special else (len(b) - 1).bit_length() or 1, []).append((w, b))
        for size, group in groups.items():
            for i in range(0, len(group), 16384):
                part = group[i : i + 16384]
                if size:
                    ids, sizes = self.merge_side_by_side([b for _, b in part])
                else:
                    each = [np.array([self.special[w]]) if w in self.special else self.merge_alone(b) for w, b in part]
                    ids, sizes = np.concatenate(each), np.array([*map(len, each)])
                self.number.update(zip((w for w, _ in part), range(len(self.size), len(self.size) + len(part))))
                self.size = np.concatenate([self.size, sizes])
                self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text begins in them and where the last ends)."""
        split = [self.words(t) for t in texts]
        distinct = set().union(*split)
        new = distinct.difference(self.number)
        if len(self.number) + len(new) > REMEMBERED:
            self.forget()
            new = distinct
        if new:
            self.learn(new)
        count = np.array([*map(len, split)], np.int64)
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(count.sum()))
        start = np.concatenate([[0], np.cumsum(self.size)])
        size = self.size[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.arange(ends[-1]) + np.repeat(start[number] - ends[:-1], size)]
        return flat, ends[np.concatenate([[0], np.cumsum(count)])]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    """One tokenizer per worker process and file."""
    return Bpe(path)


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first, chars = 0, 0
    for i, size in enumerate(sizes):
        chars += size
        if chars >= BATCH_CHARS:
            yield first, i + 1
            first, chars = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _column(df: DataFrame, c: str, kind: str):
    return F.col(c).cast(kind).alias(c)


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for every row of ``docs(doc_id, text)`` by the tokenizer file at ``path``.

    The file must be readable at that path on every executor. Null and empty texts have no ids,
    a null doc_id stays null, and repeated rows give as many rows. An empty table gives no rows.
    Other columns are not read. Words are remembered within a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _parts(pc.utf8_length(texts).to_pylist()):
                flat, at = bpe.encode(texts.slice(a, b - a).to_pylist())
                ids = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["doc_id", "ids"])
        bpe.forget()
        hand_back()

    return docs.select(_column(docs, "doc_id", "long"), _column(docs, "text", "string")).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) for every row of ``encoded(doc_id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            lists = batch.column(1)
            lists = pc.if_else(pc.is_null(lists), pa.scalar([], lists.type), lists) if lists.null_count else lists
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for a in range(0, len(lists), 1000):
                b = min(a + 1000, len(lists))
                texts = [bpe.decode(flat[at[i] : at[i + 1]]) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists.slice(a, b - a), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
        hand_back()

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): encoded as by :func:`bpe_encode`, and decoded again from the ids.

    Both happen in one task, with one worker process and without ids travelling in between.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _parts(pc.utf8_length(texts).to_pylist()):
                flat, at = bpe.encode(texts.slice(a, b - a).to_pylist())
                decoded = [bpe.decode(flat[i:j]) for i, j in zip(at[:-1], at[1:])]
                ids = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "text"])
        bpe.forget()
        hand_back()

    return docs.select(_column(docs, "doc_id", "long"), _column(docs, "text", "string")).mapInArrow(run, "doc_id long, ids array<int>, text string")
