"""Divergence of sources, ranked search and repetition rules: odd tables, brute force, and SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import check
from nodeledger.llm import divergence, lexical, queries, repetition

WORDS = "alpha Beta gamma delta epsilon zeta eta theta iota kappa straße über 漢字 naïve x".split()


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in r.integers(0, len(WORDS), n))


ROWS = [
    (1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n \n", None, None), (4, "alpha", "en", "a"), (5, "ALPHA!beta-beta 12 x1", "en", "b"),
    (6, prose(1, 80), "en", "a"), (6, prose(1, 80), "en", "a"), (7, prose(2, 400), "en", "c"), (8, prose(3, 60), "de", "a"), (9, prose(4, 60), "de", None),
    (10, "w" * 5000 + " " + "w" * 5000, "de", "a"), (11, "\n".join(["one line of text here"] * 30), "fr", "a"), (None, prose(5, 70), "en", "b"),
    (12, " ".join(f"t{k}" for k in range(3000)), "fr", "b"), (13, "no symbols %%% here ### | <a> " * 20, "fr", "a"), (14, "é\x85\xa0ﬁ İΣ 😀" * 3, "de", "a"),
    (15, "alphabet alphab alpha " + prose(6, 50) + "\n" + prose(7, 50) + "\n" + prose(6, 50), "en", "a"), (16, prose(1, 80), "en", "c"),
]
ITEMS = [(1, "alpha beta beta"), (2, None), (3, ""), (4, "unknown words only"), (5, prose(1, 30)), (5, "straße 漢字"), (None, "t1 t2 t2999"), (6, "12 one line")]
SCHEMA = "doc_id long, text string, lang string, source string, rank int, term string, block int, k string"


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns are named as columns inside the operators."""
    return spark.createDataFrame([(*r, 1, "t", 2, None) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in ITEMS], "item_id long, text string, score int, item int").repartition(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def divergence_by_hand(rows, least, ranks):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = sorted((t for t, n in held.items() if n >= least), key=str.encode)
        counts = {s: Counter() for s in {d[1] for d in mine}}
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in set(kept))
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        whole = sum(counts.values(), Counter())
        for s in counts:
            pairs = [(sum(abs(share(counts[s], t) - share(counts[o], t)) for t in kept), o) for o in counts if o != s]
            lead = [(share(counts[s], t) - share(whole, t), t) for t in kept if counts[s][t] and share(counts[s], t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", lead)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ordered) if part == "pair" or k < ranks]
    return sorted(out)


@pytest.mark.parametrize(("least", "ranks"), [(1, 3), (2, 50), (4, 2), (99, 50)])
def test_divergence_against_counting_by_hand(docs, least, ranks):
    found = divergence.source_divergence(docs, least, ranks)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == divergence_by_hand(ROWS, least, ranks)


def test_divergence_in_small_blocks_and_full_sieves(docs, monkeypatch):
    """Blocks of a text, one kept term a block, and sieves of the smallest size."""
    monkeypatch.setattr(divergence, "TERMS", 1)
    monkeypatch.setattr(divergence, "CELLS", 2)
    assert sorted(map(tuple, divergence.source_divergence(docs, 2, 4).collect())) == divergence_by_hand(ROWS, 2, 4)


def test_prefix_refinement_discards_rare_beginnings(spark):
    """A level counts documents, not terms: two terms of one document don't lift their prefix."""
    rows = [("aaab aaac aaad",), ("bbb bbbb bbbbb bbbbbbbbb",), ("bbb bbbbbbbbb",), ("aab",)]
    table = divergence.term_table(spark.createDataFrame([("en", "s", t) for (t,) in rows], "lang string, source string, text string"))
    level = table.select("lang", "terms", "doc_ends", "doc_terms").mapInArrow(divergence._level(0, 2, None), "lang string, prefix binary, complete boolean, docs long")
    by = {}
    for r in level.collect():
        by[bytes(r.prefix), r.complete] = by.get((bytes(r.prefix), r.complete), 0) + r.docs
    assert by == {(b"aa", False): 2, (b"bb", False): 2}
    assert {bytes(r.term) for r in divergence.kept_terms(table, 2).collect()} == {b"bbb", b"bbbbbbbbb"}


def test_shares_are_exact_for_large_counts():
    part = np.array([5, 10**12, 3 * 10**14], np.int64)
    whole = np.array([10**15, 10**12, 10**15 - 1], np.int64)
    assert divergence._share(part, whole).tolist() == [1 + 10**9 * int(a) // int(b) for a, b in zip(part, whole)]


def search_by_hand(rows, items, ranks):
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, c), n in zip(docs, sizes):
            m = 100 - 75 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:ranks])]
    return sorted(out, key=str)


@pytest.mark.parametrize("ranks", [1, 3, 10])
def test_search_against_scoring_all(docs, items, ranks):
    found = lexical.ranked_search(lexical.build_index(docs), items, ranks)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == search_by_hand(ROWS, ITEMS, ranks)


def test_search_in_small_blocks(docs, items, monkeypatch):
    """Blocks of one document, an item in each pass, full signatures: slower, with the same rows."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 2)
    monkeypatch.setattr(lexical, "ITEMS", 3)
    assert sorted(map(tuple, lexical.ranked_search(lexical.build_index(docs), items, 4).collect()), key=str) == search_by_hand(ROWS, ITEMS, 4)


def test_bounds_are_never_below_scores():
    r = np.random.default_rng(5)
    texts = [" ".join(f"w{int(v)}" for v in r.zipf(1.4, int(r.integers(1, 300))) % 200) for _ in range(60)]
    import pyarrow as pa

    from nodeledger.llm.terms import LETTERS_AND_DIGITS, blocks_of_terms

    block = next(blocks_of_terms(pa.array(texts), LETTERS_AND_DIGITS, 1 << 30))
    places, packed, df = lexical._signatures(block)
    asked = lexical.Queries([" ".join(f"w{k}" for k in range(j, j + 40)) for j in range(0, 160, 7)])
    asked.weigh(dict(zip(block.vocabulary.to_pylist(), df.tolist())), 60)
    m = np.array([25 + 75 * len(t.split()) * 60 // sum(len(x.split()) for x in texts) for t in texts])
    bound = lexical._bounds(asked, np.arange(len(asked.vocabulary)), np.frombuffer(packed, np.uint8).reshape(places, -1), places, m)
    exact = lexical._exact(asked, pa.array(texts), m)
    assert (bound >= exact).all() and (exact > 0).any()
    # and they exclude: most pairs lie well below the best score of their item
    assert (bound < exact.max(1, keepdims=True)).mean() > 0.5


def rules_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def repeated(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = [x for k, x in enumerate(lines) if x in lines[:k]]
    chars, many, thrice = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(repeated(3))
    line_chars = sum(len("".join(re.findall(r"[^\x20\x09-\x0D]+", x))) for x in again)
    grams = {n: sum(len(words[j]) for j in repeated(n)) for n in repetition.NGRAMS}
    failed = len(words) < 50 or 100 * thrice > 50 * len(words)
    bad = 100 * many > repetition.MANY_SYMBOLS * chars or 100 * len(again) > repetition.LINES * len(lines) or 100 * line_chars > repetition.LINE_CHARS * chars
    bad = bad or any(100 * grams[n] > percent * chars for n, percent in repetition.NGRAMS.items())
    return (len(words), chars, many, len(again), thrice, len(lines), line_chars, *grams.values(), failed, not failed and not bad)


def test_rules_against_counting_by_hand(docs):
    extra = [prose(8, 60) + " " + prose(8, 60), prose(9, 900) + "\n" + prose(9, 30), "\n\n" + prose(10, 55) + "\n", "a b\na b\n \na b"]
    rows = [(i, t) for i, t, *_ in ROWS] + [(100 + k, t) for k, t in enumerate(extra)]
    found = repetition.repetition_rules(docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert found.columns == ["doc_id", *repetition.COLUMNS, "base_failed", "kept"]
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted([(i, *rules_by_hand(t)) for i, t in rows], key=key)
    assert any(r.kept for r in found.collect())


def test_rules_on_a_text_longer_than_a_block(spark):
    text = " ".join(f"w{k}" for k in range(200_000)) + "\nsame line\nsame line\n" + "w1 w2 w3 w4 w5"
    (row,) = repetition.repetition_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(text) > 1 << 20 and (row.n_words, row.n_dup_lines, row.n_repeat_words, row.kept) == (200_009, 1, 10, True)


def test_equal_hashes_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(repetition, "mix", lambda x, salt=0: np.zeros_like(x))
    code, text = np.array([1, 2, 3, 4, 1, 2, 3, 9]), np.zeros(8, np.int64)
    assert repetition.repeated_words(code, text, 3).tolist() == [True, True, True, False, True, True, True, False]


def test_empty_tables(empty, items, docs):
    assert divergence.source_divergence(empty).collect() == []
    assert lexical.ranked_search(lexical.build_index(empty), items).collect() == []
    assert lexical.ranked_search(lexical.build_index(docs), items.limit(0)).collect() == []
    assert repetition.repetition_rules(empty).collect() == []


@pytest.mark.parametrize("name", ["op11_divergence", "op12_lexical", "op13_repetition"])
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    assert check.difference(queries.queries()[name](spark, folder).toPandas(), db.execute(queries.oracle_sql()[name]).df()) == ""
