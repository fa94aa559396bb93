"""Quality rules on repetition: how many characters lie in n-grams and lines that a text holds twice.

Rolling hashes of several n-gram lengths are formed over the words of many texts at once in numpy.
Windows with the same hash in one text are duplicates, and every word they cover is marked; the
characters of marked words are measured against all characters of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.terms import binaries
from nodeledger.llm.wordhash import Block, blocks, mix

#: n-gram length: percent of the characters of words that may lie in duplicated n-grams.
NGRAMS = {4: 50, 5: 49, 7: 47, 10: 45}
#: Percent of lines, and of the characters of words, that lines equal to an earlier one may have.
LINES, LINE_CHARS = 50, 40
#: Symbols as a percentage of the characters of words.
MANY_SYMBOLS = 10
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring places of ``at``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _mask(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True from each of ``begin`` to its ``end``; spans don't overlap."""
    edge = np.zeros(size + 1, np.int8)
    edge[begin] = 1
    edge[end] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


def word_codes(block: Block) -> np.ndarray:
    """Equal numbers for equal words of a block, for no others."""
    taken = block.data[_mask(len(block.data), block.starts, block.ends)]
    words = binaries(taken, np.append(0, np.cumsum(block.ends - block.starts)))
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _twice(key: np.ndarray) -> np.ndarray:
    """Whether each key comes up twice or more."""
    ranked = np.sort(key)
    several = ranked[1:][ranked[1:] == ranked[:-1]]
    return np.isin(key, np.unique(several)) if len(several) else np.zeros(len(key), bool)


def _covered(window: np.ndarray, n: int, words: int) -> np.ndarray:
    """The words of the ``n``-word windows that begin at ``window``."""
    edge = np.zeros(words + 1, np.int32)
    edge[window] += 1
    edge[window + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def repeated_words(code: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in an n-word window that its text holds twice or more.

    A window's hash is rolled over its words; windows with one hash are then compared word by word.
    """
    window = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
    value = mix(code.astype(np.uint64), n)
    rolled = np.zeros(max(len(code) - n + 1, 0), np.uint64)
    for k in range(n):
        rolled *= np.uint64(0xD6E8FEB86659FD93)
        rolled += value[k : k + len(rolled)]
    alike = window[_twice(rolled[window] + mix(text[window].astype(np.uint64), 77))]
    parts = [text[alike], *(code[alike + k] for k in range(n))]
    order = np.lexsort(parts)
    same = np.ones(max(len(order) - 1, 0), bool)
    for part in parts:
        same &= part[order[1:]] == part[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] = same
    twice[:-1] |= same
    return _covered(alike[order[twice]], n, len(code))


def _line_counts(block: Block, leading: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: lines with a word, those equal to an earlier one, and the characters of words in these."""
    breaks = block.data == 10
    at = np.flatnonzero(breaks)
    begin = np.sort(np.concatenate([block.offsets[:-1], at + 1]))
    end = np.sort(np.concatenate([block.offsets[1:], at]))
    text = np.repeat(np.arange(block.texts()), 1 + _sums(breaks, block.offsets))
    full = np.searchsorted(block.starts, end) > np.searchsorted(block.starts, begin)
    begin, end, text = begin[full], end[full], text[full]
    lines = binaries(block.data[_mask(len(block.data), begin, end)], np.append(0, np.cumsum(end - begin)))
    key = text * (len(lines) + 1) + lines.dictionary_encode().indices.to_numpy()
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    n = block.texts()
    in_lines = np.zeros(n, np.int64)
    np.add.at(in_lines, text[again], (leading[end] - leading[begin])[again])
    return np.bincount(text, minlength=n), np.bincount(text[again], minlength=n), in_lines


def measures(block: Block) -> dict[str, np.ndarray]:
    """Every measure of the texts of a block."""
    code, text = word_codes(block), block.text_of_word()
    # characters of words before each byte
    leading = np.append(0, np.cumsum(_FIRST_BYTE[block.data] & _mask(len(block.data), block.starts, block.ends)))
    chars = leading[block.ends] - leading[block.starts]
    by_text = lambda v: _sums(v, block.word_at)
    lines, dup_lines, dup_line_chars = _line_counts(block, leading)
    out = {
        "n_words": np.diff(block.word_at),
        "word_chars": by_text(chars),
        "n_symbols": _sums(SYMBOLS[block.data], block.offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": by_text(repeated_words(code, text, 3)),
        "n_lines": lines,
        "dup_line_chars": dup_line_chars,
    }
    for n in NGRAMS:
        out[f"dup_{n}gram_chars"] = by_text(np.where(repeated_words(code, text, n), chars, 0))
    return out


COLUMNS = (*BASE, "n_lines", "dup_line_chars", *(f"dup_{n}gram_chars" for n in NGRAMS))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            found = measures(block)
            columns = [pa.array(found[c].astype(np.int64)) for c in COLUMNS]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.texts()), *columns], names=["doc_id", *COLUMNS])


def repetition_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts of ``COLUMNS``, base_failed, kept) for every row of ``docs(doc_id, text)``.

    Words are runs of characters other than white space. ``base_failed``: fewer than 50 words, or
    more than half of them in 3-word windows that the text holds twice or more. Otherwise a text is
    kept unless the characters of words in duplicated n-grams of a length in ``NGRAMS``, those in lines
    equal to an earlier one, the share of such lines, or the symbols exceed their percentage. The first of
    several equal windows counts as duplicated too, the first of several equal lines doesn't.

    Null, empty and word-less texts have zeros and aren't kept. A null doc_id stays null and repeated
    rows give as many rows. An empty table gives no rows. Other columns are not read. Nothing is
    compared across rows, and a text of any length is measured as a whole.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    over = (100 * F.col("n_symbols") > MANY_SYMBOLS * F.col("word_chars")) | (100 * F.col("n_dup_lines") > LINES * F.col("n_lines")) | (100 * F.col("dup_line_chars") > LINE_CHARS * F.col("word_chars"))
    for n, percent in NGRAMS.items():
        over = over | (100 * F.col(f"dup_{n}gram_chars") > percent * F.col("word_chars"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~over)
