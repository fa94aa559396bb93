"""Cases that earlier versions got wrong."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from nodeledger.llm import bpe, components, fingerprint, gridjoin, minhash, queries, tokenfiles, toxicity
from nodeledger.llm.wordhash import blocks


def thue_morse(a, b, n):
    word, other = a, b
    while len(word) < n:
        word, other = word + other, other + word
    return word, other


@pytest.fixture(scope="module")
def regular():
    """Pairs of different words with equal polynomials modulo 2**64."""
    return [*thue_morse("a", "b", 2048), *thue_morse("xay", "xby", 6000)]


def test_words_of_a_regular_build_are_told_apart(spark, regular, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    docs = spark.createDataFrame([(k, f"say {w} twice {w}") for k, w in enumerate(regular)], "doc_id long, text string").coalesce(1)
    tokenfiles.write_token_files(docs, path, f"{tmp_path}/tokens", end_id=1)
    library = Tokenizer.from_file(path)
    library.no_truncation(), library.no_padding()
    for r in tokenfiles.read_token_files(spark, f"{tmp_path}/tokens").collect():
        want = library.encode(f"say {regular[r.doc_id]} twice {regular[r.doc_id]}", add_special_tokens=False).ids + [1]
        assert np.frombuffer(r.ids, "<u4").tolist() == want
    common = " ".join(f"w{k}" for k in range(3))
    pairs = spark.createDataFrame([(k, f"{w} {common}") for k, w in enumerate(regular)], "doc_id long, text string")
    assert all(r.kept for r in minhash.near_duplicates(pairs, 3, 85).collect())


def test_vectors_of_any_size_keep_their_direction(spark):
    rows = [(1, [1e-200] * 4), (2, [1e200] * 4), (3, [1e200] * 4), (4, [5e-324, 0.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0, 0.0]), (6, [1e308, 1e308, 1e308, 9e307]), (7, [-1e300] * 4)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in gridjoin.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 6: (3, 1), 4: (1, 4), 5: (1, 4), 7: (0, 7)}


def test_further_links_join_components_and_new_ids(spark):
    place = spark.createDataFrame([(1, 1), (5, 1), (2, 2), (7, 2), (3, 3), (9, 3)], "id long, component long")
    links = spark.createDataFrame([(5, 7), (9, 20), (30, 31), (8, 8)], "src long, dst long")
    found = dict(map(tuple, components.linked_further(place, links).collect()))
    assert found == {1: 1, 5: 1, 2: 1, 7: 1, 3: 3, 9: 3, 20: 3, 30: 30, 31: 30}
    assert dict(map(tuple, components.linked_further(place, links.limit(0)).collect())) == {1: 1, 5: 1, 2: 2, 7: 2, 3: 3, 9: 3}


def near_by_pairs(texts, words, percent):
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    place = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((place[a], place[b]))
            place = {k: x if v == y else v for k, v in place.items()}
    return place


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_among_templates(spark, words, percent):
    """Groups alike in part around true pairs, so that buckets stay mixed after the stars."""
    r = np.random.default_rng(17)
    texts = {}
    for group in range(6):
        template = [f"g{group}w{k}" for k in range(120)]
        for copy in range(25):
            changed = list(template)
            for at in r.choice(120, int(r.choice([0, 1, 2, 3, 4, 6, 9, 14])), replace=False):
                changed[at] = f"new{int(r.integers(1 << 40))}"
            texts[1000 - 25 * group - copy] = " ".join(changed[: int(r.integers(100, 121))])
    found = minhash.near_duplicates(spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(4), words, percent)
    want = near_by_pairs(texts, words, percent)
    assert 10 < len(set(want.values())) < 150
    assert {x.doc_id: x.component_id for x in found.collect()} == want


def test_columns_named_as_the_operators_own(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2), (2, "a b c d e f", 3, 4)], "doc_id long, text string, _gone long, _id long")
    assert [tuple(x) for x in minhash.keep_one(docs).collect()] == [(1, "a b c d e f", 1, 2)]


def likeness_by_hand(a, b):
    """Of 64 classes of 24-byte windows that either text fills, the share with the same smallest hash."""
    if a == b:
        return 1.0
    slots = lambda p: [p[24 + 4 * k : 28 + 4 * k] for k in range(64)]
    used = [(x, y) for x, y in zip(slots(a), slots(b)) if (x, y) != ("----", "----")]
    return sum(x == y for x, y in used) / len(used) if used else 0.0


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_edits_and_likeness_over_ranges(spark, parts):
    r = np.random.default_rng(4)
    texts = {int(i): " ".join(f"w{int(v)}" for v in r.integers(0, 50, int(n))) for i, n in zip(r.permutation(400)[:90] - 50, r.integers(0, 120, 90))}
    rows = [*texts.items(), (None, "no id at all"), *([(min(texts), texts[min(texts)])] * 3), (max(texts) + 1, "ä漢😀" * 50), (max(texts) + 2, None)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = fingerprint.with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    held = {i: t or "" for i, t in rows if i is not None}
    ids = sorted(held)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    prints = {i: fingerprint.Text(t.encode()).fingerprint() for i, t in held.items()}
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in found) == sorted((i is None, i or 0) for i, _ in rows)
    for x in found:
        if x.doc_id is None:
            assert (x.near_next, x.edited) == (0.0, "no id at a")[:1] + (x.edited,) and x.edited == "no id at "
            continue
        text, other = held[x.doc_id], held[after[x.doc_id]]
        q = len(text) // 4
        edited = text[: len(text) - q] + other[:q]
        print_of_edit = fingerprint.Text(edited.encode()).fingerprint()
        assert (x.n_chars, x.edited, x.fingerprint, x.edited_fingerprint) == (len(text), edited, prints[x.doc_id], print_of_edit)
        assert x.near_edited == likeness_by_hand(prints[x.doc_id], print_of_edit)
        assert x.near_next == likeness_by_hand(prints[x.doc_id], prints[after[x.doc_id]])


def test_texts_longer_than_a_step_of_prefixes(spark):
    """Above 8 MB, where running sums are continued from one step to the next."""
    text = "0123456789abcdef" * (1 << 19) + "tail"
    (row,) = fingerprint.with_edits(spark.createDataFrame([(5, text)], "doc_id long, text string")).collect()
    q = len(text) // 4
    assert row.edited == text[: len(text) - q] + text[:q] and row.fingerprint == fingerprint.Text(text.encode()).fingerprint()
    whole = fingerprint.Text(text.encode())
    assert whole.same(0, whole, 16, len(text) - 20) and whole.common_extension(0, whole, 16) == len(text) - 4 - 16
    assert not whole.same(0, whole, 16, len(text) - 19)


def test_one_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    plan = fingerprint.with_edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_no_edits_of_an_empty_table(spark):
    assert fingerprint.with_edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_round_trip_equals_encoding_then_decoding(spark):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    rows = [(1, None), (2, ""), (3, "it's 3 o'clock\n\n\tand  more"), (None, "äöü 漢字 😀 <|endoftext|>"), (4, "x" * 3000), (4, "x" * 3000), (5, "ab " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    once, twice = (sorted(df.collect(), key=key) for df in (bpe.bpe_round_trip(docs, path), bpe.bpe_decode(bpe.bpe_encode(docs, path), path)))
    assert once == twice and [r.text for r in once][:2] == ["", ""]
    assert bpe.bpe_round_trip(docs.limit(0), path).collect() == []


def test_toxicity_patterns_against_regular_expressions():
    """Phrases, insults to the reader and words with marks, by letters, never across texts."""
    texts = [
        "You are an Idiot.", "i.d.1.o.t!!", "SCUM$$$ said one, and so said all", "an idiot walks far away and then you",
        "please SHUT, up!", "please shut", "up with it", "drop  dead\nnow", "Nobody wants you", "scum", "you there", "", "...", None,
    ]
    lexicon, reader, phrases = toxicity._pattern_hashes()
    names = {int(h): p for n, rows in phrases.items() for h, p in zip(toxicity._chained(rows), [p for p in toxicity.PHRASES if len(p.split()) == n])}
    names |= {int(h): w for h, w in zip(lexicon, toxicity.LEXICON)} | {int(toxicity._INSULT_TO_READER): "to reader"}
    found = {k: set() for k in range(len(texts))}
    for block in blocks(pa.array(texts)):
        text, feature = toxicity.stems(block)
        for t, f in zip((text + block.first).tolist(), feature.tolist()):
            found[t] |= {names[f]} & {*names.values()} if f in names else set()
    want = {k: set() for k in range(len(texts))}
    digits = str.maketrans("013457", "oieast")
    for k, t in enumerate(texts):
        words = [w for w in (re.sub("[^a-z]", "", w.lower().translate(digits)) for w in (t or "").split()) if w]
        line = " ".join(words)
        want[k] |= {p for p in toxicity.PHRASES if re.search(rf"(^| ){p}( |$)", line)} | ({*words} & {*toxicity.LEXICON})
        for i, w in enumerate(words):
            if w in toxicity.LEXICON and {*words[max(0, i - toxicity.BEFORE) : i], *words[i + 1 : i + 1 + toxicity.AFTER]} & {*toxicity.READER}:
                want[k].add("to reader")
    assert found == want
    assert want[0] == {"idiot", "to reader"} and want[1] == {"idiot"} and want[3] == {"idiot"} and want[4] == {"shut up"} and not want[5] | want[6]


def test_rows_that_share_an_id_follow_each_other_in_the_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation(), library.no_padding()
    rows = [(k % 7 if k % 3 else 4, " ".join(f"word{k % 11}" for _ in range(k % 13)), k) for k in range(200)] + [(None, "no id", 1), (9, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, turn int").repartition(5)
    tokenfiles.write_token_files(docs, path, f"{tmp_path}/shared", end_id=1)
    found = sorted(tokenfiles.read_token_files(spark, f"{tmp_path}/shared").collect(), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    want = sorted((-1 if i is None else i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, _ in rows)
    assert sorted(zip(ids, (np.frombuffer(r.ids, "<u4").tolist() for r in found))) == want
    tokenfiles.write_token_files(docs.limit(0), path, f"{tmp_path}/none", end_id=1)
    assert tokenfiles.read_token_files(spark, f"{tmp_path}/none").collect() == []
