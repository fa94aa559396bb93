"""Words of many texts at once: byte arrays in, word hashes out, without a Python loop over words.

A word is a run of bytes other than space and 0x09 to 0x0D. Its hash is a polynomial over random
64-bit codes of its bytes, read off one prefix sum over a block of texts (arithmetic modulo 2**64).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_random = np.random.default_rng(20240229)
_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _CODE.copy()
_FOLDED[65:91] = _CODE[97:123]
_MOVE = _random.integers(1, 2**63, (48, 48), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}

# character kinds for word shapes: lower case and non-ASCII 0, upper case 1, digit 2, each mark its own
_KIND = np.zeros(256, np.int64)
_KIND[65:91] = 1
_KIND[48:58] = 2
for _i, _c in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _KIND[_c] = 3 + _i


#: Bytes of a word up to which its polynomial tells it apart.
LONG_WORD = 64


def data_lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64, kept for later calls."""
    have = _powers[base]
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 2**64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Some consecutive texts: their bytes, where each begins, and where their words lie."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_at: np.ndarray  # words of text i: word_at[i] to word_at[i + 1]

    def texts(self) -> int:
        return len(self.offsets) - 1

    def _ranges(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        return total[self.ends] - total[self.starts]

    def hashes(self, fold_case: bool = True, at_most: int | None = None, exact_long: bool = False) -> np.ndarray:
        """One value per word; of its first ``at_most`` bytes only, if given.

        Polynomials modulo 2**64 can be made to agree for long words of a regular build; with
        ``exact_long``, words of more than ``LONG_WORD`` bytes have a cryptographic hash instead.
        """
        ends, n = self.ends, len(self.data)
        if at_most:
            self.ends = np.minimum(self.ends, self.starts + at_most)
        values = (_FOLDED if fold_case else _CODE)[self.data] * powers(_BASE, n)
        out = mix(self._ranges(values) * powers(_INVERSE, n)[self.starts] if n else np.zeros(0, np.uint64))
        if exact_long:
            folded = data_lower(self.data) if fold_case else self.data
            for k in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
                word = folded[self.starts[k] : self.ends[k]].tobytes()
                out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.ends = ends
        return out

    def shapes(self) -> np.ndarray:
        """One value per word for the changes between kinds of characters in it."""
        kind = _KIND[self.data]
        before = np.concatenate([[47], kind[:-1]]) if len(kind) else kind
        before[self.starts] = 47
        return mix(self._ranges(np.where(kind != before, _MOVE[before, kind], np.uint64(0))), 1)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts()), np.diff(self.word_at))


def text_buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; missing texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), where


def blocks(texts: pa.Array) -> Iterator[Block]:
    if not len(texts):
        return
    data, offsets = text_buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        part = data[offsets[first] : offsets[last]]
        where = offsets[first : last + 1] - offsets[first]
        inside = ~_SPACE[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[where] = True
        if len(part):
            before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
            after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
            starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        else:
            starts = ends = np.zeros(0, np.int64)
        yield Block(first, part, where, starts, ends, np.searchsorted(starts, where))
        first = last
