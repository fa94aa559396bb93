"""Toxicity by weak supervision: many noisy voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm import linear
from nodeledger.llm.store import hand_back, written
from nodeledger.llm.wordhash import Block, blocks, mix

SAMPLE_PER_CLASS = 4000
#: Lengths in bytes of the word beginnings that serve as features and, where telling, as voters.
STEMS = (5, 7, 9)
#: Files of the written sample.
FILES = 16

# Common insults, each a lexicon voter.
LEXICON = (
    "idiot stupid moron loser pathetic worthless scum clown trash disgusting dumb garbage filth "
    "fool jerk ugly hate vermin imbecile"
).split()


# Phrases, each a pattern voter; and the words by which an insult meets its reader.
PHRASES = (
    "shut up|get lost|drop dead|go die|go to hell|kill yourself|hate you|hurt you|kill you|find you|"
    "watch your back|make you pay|you will regret|you will pay|you people|your kind|people like you|"
    "nobody likes you|nobody wants you|shame on you"
).split("|")
READER = "you your youre u ur yourself".split()
#: Words before and after an insult among which the reader may be named.
BEFORE, AFTER = 4, 2

# letters in lower case, digits as the letters they stand for; marks are no part of a word
_LETTER = np.zeros(256, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
_LETTER[[ord(c) for c in "013457"]] = [ord(c) for c in "oieast"]
_INSULT_TO_READER = np.uint64(0x5EC0D9E25011A7)


def letter_words(block: Block) -> Block:
    """The words of a block by their letters alone: ``i.d.1.o.t!!`` is ``idiot``; words without any are left out."""
    data = _LETTER[block.data]
    at = np.concatenate([[0], np.cumsum(data != 0)])
    starts, ends = at[block.starts], at[block.ends]
    some = ends > starts
    word_at = np.concatenate([[0], np.cumsum(some)])[block.word_at]
    return Block(block.first, data[data != 0], at[block.offsets], starts[some], ends[some], word_at)


def _hashes_of(words: list[str]) -> np.ndarray:
    return np.concatenate([mix(letter_words(b).hashes(), 41) for b in blocks(pa.array(words))])


@lru_cache(maxsize=1)
def _pattern_hashes() -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Hashes of the lexicon, of the words for the reader, and of phrases by their number of words."""
    phrases: dict[int, list[np.ndarray]] = {}
    for phrase in PHRASES:
        parts = phrase.split()
        phrases.setdefault(len(parts), []).append(_hashes_of(parts))
    return _hashes_of(LEXICON), _hashes_of(READER), {n: np.stack(p) for n, p in phrases.items()}


def _chained(words: np.ndarray) -> np.ndarray:
    """One value for each row of words."""
    out = np.zeros(len(words), np.uint64)
    for column in words.T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column, 43)
    return out


def patterns(word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) where a phrase lies, or an insult near a word for the reader, within one text."""
    lexicon, reader, phrases = _pattern_hashes()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for n, rows in phrases.items():
        at = np.flatnonzero(np.isin(word[: max(len(word) - n + 1, 0)], rows[:, 0]))
        at = at[text[at] == text[at + n - 1]]
        feature = _chained(word[at[:, None] + np.arange(n)])
        hit = np.isin(feature, _chained(rows))
        found.append((text[at[hit]], feature[hit]))
    insult = np.flatnonzero(np.isin(word, lexicon))
    near = insult[:, None] + np.array([*range(-BEFORE, 0), *range(1, AFTER + 1)])
    inside = (near >= 0) & (near < len(word))
    near = np.clip(near, 0, max(len(word) - 1, 0))
    hit = (inside & (text[near] == text[insult][:, None]) & np.isin(word[near], reader)).any(axis=1) if len(insult) else np.zeros(0, bool)
    found.append((text[insult[hit]], np.full(hit.sum(), _INSULT_TO_READER)))
    return np.concatenate([t for t, _ in found]), np.concatenate([f for _, f in found])


def stems(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for each word and word beginning by its letters, and each pattern; features are 64 bits."""
    block = letter_words(block)
    word, text = mix(block.hashes(), 41), block.text_of_word()
    parts = [word, *(mix(block.hashes(at_most=k), 41 + k) for k in STEMS)]
    pattern_text, pattern = patterns(word, text)
    return np.concatenate([np.tile(text, len(parts)), pattern_text]), np.concatenate([*parts, pattern])


def present(block: Block, known: np.ndarray) -> linear.Rows:
    """Which of the sorted ``known`` features each text has, at value 1, as positions in it."""
    text, feature = stems(block)
    at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
    hit = known[at] == feature
    rows = linear.merged(text[hit], at[hit], np.ones(hit.sum()), block.texts(), len(known))
    return _of_ones(rows.at, rows.index.astype(np.int32))


def _of_ones(at: np.ndarray, index: np.ndarray) -> linear.Rows:
    return linear.Rows(at, index, np.broadcast_to(1.0, len(index)))


def _voter_features() -> np.ndarray:
    """The features of lexicon and pattern voters."""
    lexicon, _, phrases = _pattern_hashes()
    return np.concatenate([lexicon, *map(_chained, phrases.values()), [_INSULT_TO_READER]])


def vocabulary(sample: DataFrame, least_texts: int = 3) -> np.ndarray:
    """Lexicon, patterns and every feature of at least ``least_texts`` texts of the sample, sorted.

    Texts are counted within tasks first, and only what is frequent enough comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                text, new = stems(block)
                order = np.lexsort((text, new))
                text, new = text[order], new[order]
                first = np.ones(len(new), bool)
                first[1:] = (new[1:] != new[:-1]) | (text[1:] != text[:-1])
                # counts so far and those of the block, put together: memory by different features, not by all
                new, times = np.unique(new[first], return_counts=True)
                both = np.union1d(feature, new)
                total = np.zeros(len(both), np.int64)
                total[np.searchsorted(both, feature)] += n
                total[np.searchsorted(both, new)] += times
                feature, n = both, total
        yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(n)], names=["feature", "n"])
        hand_back()

    counts = sample.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least_texts).select("feature").toArrow().column(0).to_numpy()
    return np.union1d(found.astype(np.int64).view(np.uint64), _voter_features())


def known_features(sample: DataFrame, known: np.ndarray) -> tuple[linear.Rows, np.ndarray]:
    """(which of the ``known`` features each sampled text has, labels), by doc_id.

    Texts stay in the tasks; four bytes per text and known feature come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                rows = present(block, known)
                has = pa.Array.from_buffers(pa.binary(), block.texts(), [None, pa.py_buffer((4 * rows.at).astype(np.int32)), pa.py_buffer(rows.index)])
                ids, y = (batch.column(i).slice(block.first, block.texts()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, y, has], names=["doc_id", "y", "has"])
        hand_back()

    table = sample.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, has binary").toArrow()
    order = np.argsort(table.column(0).to_numpy())
    has = table.column(2).to_pylist()
    index = [np.frombuffer(has[i], np.int32) for i in order]
    at = np.cumsum([0, *map(len, index)])
    return _of_ones(at, np.concatenate([np.zeros(0, np.int32), *index])), table.column(1).to_numpy()[order].astype(float)


def voters(rows: linear.Rows, known: np.ndarray, y: np.ndarray, most: int = 200, times: float = 200.0) -> np.ndarray:
    """Positions of features that vote "toxic" where they occur: lexicon, patterns and found beginnings.

    A beginning qualifies if it occurs in a hundredth of the toxic texts, in 4 at least, and is
    ``times`` as frequent there as in the others; the ``most`` frequent of those serve.
    """
    in_toxic = np.repeat(y == 1, np.diff(rows.at))
    toxic, clean = (np.bincount(rows.index[part], minlength=len(known)).astype(float) for part in (in_toxic, ~in_toxic))
    ratio = ((toxic + 0.1) / y.sum()) / ((clean + 0.1) / (1 - y).sum())
    good = np.flatnonzero((toxic >= max(4, y.sum() / 100)) & (ratio >= times))
    return np.union1d(np.searchsorted(known, _voter_features()), good[np.argsort(-toxic[good], kind="stable")][:most])


def label_model(votes: np.ndarray, prior: float, rounds: int = 30) -> np.ndarray:
    """P(toxic) per row of the 0/1 matrix ``votes`` (rows x voters), from the votes alone.

    Generative model: a voter says "toxic" where it fires and abstains elsewhere, and is right
    with an accuracy of its own; one more voter says "clean" where all abstain. Accuracies are
    found by expectation maximisation, starting from 0.8, the belief of a few votes. Voters that
    fire together beyond what the class explains share their evidence: from the correlations of
    the residuals comes each voter's number of near-copies, by which its log-odds are divided.
    """
    none = votes.sum(axis=1) == 0
    p = np.where(none, 0.05, 0.8)
    discount = np.ones(votes.shape[1])
    for step in range(rounds):
        right = np.clip((votes.T @ p + 4) / (votes.sum(axis=0) + 5), 0.55, 0.99)
        clean = np.clip(((1 - p)[none].sum() + 4) / (none.sum() + 5), 0.55, 0.99)
        if step % 10 == 5:
            toxic, other = (votes.T @ p) / (p.sum() + 1), (votes.T @ (1 - p)) / ((1 - p).sum() + 1)
            residual = votes - np.outer(p, toxic) - np.outer(1 - p, other)
            scale = np.sqrt((residual**2).mean(axis=0)) + 1e-9
            correlation = np.abs(residual.T @ residual) / len(p) / np.outer(scale, scale)
            discount = np.maximum(np.where(correlation > 0.5, correlation, 0).sum(axis=1), 1)
        odds = votes @ (np.log(right / (1 - right)) / discount) - none * np.log(clean / (1 - clean))
        p = linear.sigmoid(np.log(prior / (1 - prior)) + odds)
    return p


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) of a linear classifier of the label model's posteriors."""
    sample = linear.labelled_rows(docs, labels, "toxic", per_class)
    nothing = np.zeros(1, np.uint64), np.zeros(1), -5.0
    if sample is None:
        return nothing
    # a bounded number of rows, read twice; more files than one so that more than one task reads them
    sample = written(sample.repartition(FILES, "doc_id"), "toxicity", group_mb=16)
    known = vocabulary(sample)
    rows, y = known_features(sample, known)
    if not len(y) or y.min() == y.max():
        return nothing
    chosen = voters(rows, known, y)
    column = np.full(len(known), -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    which = column[rows.index]
    fired = np.flatnonzero(which >= 0)
    votes = np.zeros((len(y), len(chosen)))
    votes[np.searchsorted(rows.at, fired, side="right") - 1, which[fired]] = 1
    # even odds before any vote: the voter for clean texts carries how common those are
    posterior = label_model(votes, 0.5)
    weights, bias = linear.fit_ftrl(rows, posterior, alpha=0.3, l1=5.0, width=len(known))
    used = weights != 0
    used[0] = True  # at least one feature to look up
    return known[used], weights[used], bias


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score) for every row of ``docs(doc_id, text)``.

    Null, empty and word-less texts get the score of the bias alone, a low one. Without labels of
    both classes no text scores as toxic. A null doc_id is not held out; repeated rows are scored
    alike; an empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    known, weights, bias = fit(docs, labels, per_class)
    scores = linear.scored(docs, lambda block: present(block, known), weights, bias)
    return scores.select("doc_id", F.coalesce(linear.held_out("doc_id"), F.lit(False)).alias("held_out"), "score")
