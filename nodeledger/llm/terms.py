"""Terms of many texts at once: which distinct term stands where, exactly, without a Python loop over terms.

A term is a maximal run of the bytes of a class. Both classes hold every byte of the characters
beyond ASCII, so runs of bytes are runs of characters. A to Z become lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from nodeledger.llm.wordhash import text_buffers

_ascii = np.arange(256)
LETTERS = (_ascii >= 0x80) | ((_ascii | 0x20) >= 0x61) & ((_ascii | 0x20) <= 0x7A) & (_ascii < 0x80)
LETTERS_AND_DIGITS = LETTERS | (_ascii >= 0x30) & (_ascii <= 0x39)
_LOWER = _ascii.astype(np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Terms:
    """The terms of some consecutive texts."""

    first: int  # place of the first text
    vocabulary: pa.LargeBinaryArray  # distinct terms, ascending byte by byte
    term: np.ndarray  # vocabulary place of each occurrence, in the order of the texts
    at: np.ndarray  # occurrences of text i: at[i] to at[i + 1]

    def texts(self) -> int:
        return len(self.at) - 1

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of every term of a text, ascending."""
        width = max(len(self.vocabulary), 1)
        key = np.repeat(np.arange(self.texts()) * width, np.diff(self.at)) + self.term
        key.sort()
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        return key[new] // width, key[new] % width, np.diff(np.append(new, len(key)))


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _terms(first: int, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Terms:
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])[: len(inside)]))
    end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)[: len(inside)])) + 1
    runs = binaries(_LOWER[data[inside]], np.append(0, np.cumsum(end - start)))
    coded = runs.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return Terms(first, coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()], np.searchsorted(start, offsets))


def blocks_of_terms(texts: pa.Array, kind: np.ndarray, block_bytes: int, block_texts: int | None = None) -> Iterator[Terms]:
    """The terms of consecutive texts of about ``block_bytes`` together; a longer text is alone."""
    data, offsets = text_buffers(texts)
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), n, first + (block_texts or n))
        yield _terms(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], kind)
        first = last
