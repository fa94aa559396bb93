"""Each corpus operator on odd tables, and against a brute-force version on a small fixture."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

import corpus_pipeline
from nodeledger.llm import bpe, components, fingerprint, gridjoin, linear, minhash, mixing, pii, quality, queries, suffixes, tokenfiles, toxicity

PASSAGE = "one passage of more than fifty bytes that several documents have in common, word for word "
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in r.integers(0, len(WORDS), n))


ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "two words"), (5, "one"), (6, prose(1)), (7, prose(1)), (8, prose(1).upper()),
    (9, prose(1) + " changed"), (10, PASSAGE + prose(2)), (11, prose(3) + " " + PASSAGE), (12, PASSAGE + PASSAGE + "äöü 漢字 😀"),
    (13, "mail a.b@c.example.org or 10.0.0.1, +1 (555) 010-9999"), (14, "card 4111 1111 1111 1111 <|endoftext|> it's 3 o'clock"),
    (15, prose(4, 3000)), (15, prose(4, 3000)), (16, "x" * 5000), (None, "a row without an id"), (17, "\x1c\x85\xa0 İΣ ﬁ é"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns, some named as columns inside the operators."""
    rows = [(i, t, "en" if k % 2 else None, None if k == 3 else f"s{k % 3}", len(t or ""), k, "z") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket long, rep string").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (7, 1, 0), (9, 1, 0), (16, 0, 1), (4, 0, 1), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")


def texts():
    return [(i, t or "") for i, t in ROWS]


def grouped(ids, linked):
    place = {i: i for i in ids}
    for a, b in itertools.combinations(sorted(ids), 2):
        if linked(a, b):
            x, y = place[a], place[b]
            place = {k: min(x, y) if v in (x, y) else v for k, v in place.items()}
    return place


def test_components_of_chain_star_and_null(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (None, 3)]
    found = dict(components.components(spark.createDataFrame(chain, "src long, dst long")).collect())
    assert found == {k: 0 for k in range(61)} | {k: 100 for k in [100, *range(200, 250)]}


def test_near_duplicates_against_all_pairs(docs):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in texts() if i is not None}
    alike = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    want = grouped(sets, alike)
    rows = minhash.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert want[7] == 6 and want[8] == 6 and want[9] == 6


def test_repeats_against_every_window(docs):
    first, data = {}, {i: t.encode() for i, t in texts() if i is not None}
    for i in sorted(data):
        for p in range(len(data[i]) - 49):
            first.setdefault(data[i][p : p + 50], i)
    for r in suffixes.without_repeats(docs).collect():
        text = dict(texts())[None].encode() if r.doc_id is None else data[r.doc_id]
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - 49 if r.doc_id is not None else 0):
            if first[text[p : p + 50]] < r.doc_id:
                gone[p : p + 50] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(text), gone.sum(), (np.diff(gone.astype(int)) == -1).sum(), kept)


@pytest.mark.parametrize("text", [b"", b"z", b"banana", b"a" * 40, b"ab" * 30, bytes(np.random.default_rng(1).integers(97, 99, 400).astype(np.uint8))])
def test_suffix_array_is_sorted(text):
    order, _ = suffixes.suffix_array(np.frombuffer(text, np.uint8), 50)
    assert sorted(order.tolist()) == [*range(len(text))]
    prefixes = [text[i : i + 50] for i in order]
    assert prefixes == sorted(prefixes)


def test_bpe_equals_the_library_and_round_trips(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_file("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = bpe.bpe_decode(bpe.bpe_encode(docs, path), path).collect()
    want = sorted((i or 0, t, library.encode(t, add_special_tokens=False).ids) for i, t in texts())
    assert sorted((r.doc_id or 0, r.text, r.ids) for r in rows) == want
    alone = bpe.loaded(path)
    for word in ("a" * 300, "ab" * 200, " " + "thethe" * 30):
        assert alone.merge_alone(word.encode()).tolist() == library.encode(word, add_special_tokens=False).ids


def test_token_files_equal_the_library(spark, docs, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_file("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    tokenfiles.write_token_files(docs, path, f"file://{tmp_path}/t", end_id=1)
    rows = sorted(tokenfiles.read_token_files(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r.start)
    at = 0
    for r, (i, t) in zip(rows, sorted(texts(), key=lambda x: -1 if x[0] is None else x[0]), strict=True):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (i, at, len(ids) // 4, zlib.crc32(ids))
        at += r.n_tokens


def test_variable_length_code_round_trips():
    r = np.random.default_rng(2)
    values = r.integers(0, 2**32, 1000) >> r.integers(0, 32, 1000)
    counts = np.array([0, 3, 1, 496, 0, 500])
    (control, _), (data, _) = tokenfiles.pack(values, counts)
    assert (tokenfiles.unpack(control, data, counts) == values).all()


def test_base_spans_equal_plain_patterns():
    r = np.random.default_rng(3)
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for _ in range(3000):
        text = "".join(r.choice([*"01 23.-+@ab()4 5"], r.integers(0, 45)))
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text) if pii.valid(k, m[0]))
        assert pii.base_spans(text) == want


def test_tagger_gradients_and_learning():
    tagger, r = pii.Tagger(), np.random.default_rng(0)
    tagger.p = {c: v.astype(float) for c, v in tagger.p.items()}
    x, y = r.integers(0, 130, (3, 7)), r.integers(0, 9, (3, 7))
    _, g = tagger.gradients(x, y)
    for c, v in tagger.p.items():
        at = np.unravel_index(np.argmax(np.abs(g[c])), v.shape)
        v[at] += 1e-4
        up = tagger.gradients(x, y)[0]
        v[at] -= 2e-4
        down = tagger.gradients(x, y)[0]
        v[at] += 1e-4
        assert abs((up - down) / 2e-4 - g[c][at]) < 1e-3


def test_pii_keeps_base_spans_and_redacts(docs):
    tagger = pii.train([f"call +1 (555) 010-{k:04d} or mail u{k}@h{k}.example.com today" for k in range(30)], 60)
    rows = pii.pii_spans(docs, tagger).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    hidden = {r.doc_id: r for r in pii.redacted(docs, tagger).collect()}
    assert hidden[13].text == "mail [email] or [ip], [phone]" and hidden[1].text is None and hidden[13].rep == "z"
    assert pii.redacted(docs, tagger).columns == docs.columns


def test_added_spans_maximise_the_score():
    text = "call 555-010-9999 or 555 010 9999 now"
    found = [(5, 3, 17, 60.0), (5, 3, 33, 55.0), (21, 3, 33, 50.0)]
    assert pii.added_spans(text, found, []) == [(5, 3, 17), (21, 3, 33)]
    assert pii.added_spans(text, found, [(6, 2, 8)]) == [(21, 3, 33)]


def test_classifiers_on_odd_tables(spark, docs, labels):
    none = labels.limit(0)
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        for known in (labels, none):
            rows = scores(docs, known).collect()
            assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
            want = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in ROWS if i is not None} | {None: False}
            assert {r.doc_id: r.held_out for r in rows} == want
        assert scores(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, none).count() == len(ROWS)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for scores, label, at in ((quality.quality_scores, "quality", 0.3), (toxicity.toxicity_scores, "toxic", 0.5)):
        rows = scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
        right = (rows["score"] >= at) == (rows[label] == 1)
        assert right[rows[label] == 1].mean() > 0.9 and right[rows[label] == 0].mean() > 0.98


def test_ftrl_learns_soft_targets():
    rows = linear.Rows(np.arange(201), np.tile([0, 1], 100), np.ones(200))
    w, bias = linear.fit_ftrl(rows, np.tile([0.9, 0.1], 100), width=2, l1=0.0)
    assert linear.sigmoid(w[0] + bias) > 0.8 and linear.sigmoid(w[1] + bias) < 0.2


def test_label_model_finds_toxic_rows_despite_copies_of_voters():
    r = np.random.default_rng(4)
    y = r.random(600) < 0.3
    votes = np.array([(r.random(600) < np.where(y, 0.5, 0.01)) for _ in range(6)]).T
    votes = np.column_stack([votes, votes[:, :1], votes[:, :1]]).astype(float)
    p = toxicity.label_model(votes, 0.3)
    assert ((p > 0.5) == y).mean() > 0.93


def test_edits_and_likeness(docs):
    ids = sorted({i for i, _ in ROWS if i is not None})
    own = {i: t for i, t in texts()}
    for r in fingerprint.with_edits(docs).collect():
        text, q = own[r.doc_id], len(own[r.doc_id]) // 4
        following = "" if r.doc_id is None else own[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        assert r.edited == text[: len(text) - q] + following[:q] and r.n_chars == len(text)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.edited == text)
        a, b = text.encode(), r.edited.encode()
        assert r.common_bytes == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_span_equality_and_common_extension():
    a, b = fingerprint.Text("xxabcabc-abd"), fingerprint.Text("abcabc-abz")
    assert a.same(2, b, 0, 6) and not a.same(2, b, 1, 3)
    assert a.common_extension(2, b, 0) == 9 and a.common_extension(0, b, 0) == 0


def test_embedding_links_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 16)
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 12))
    x = [(centres[k % 6] + r.normal(size=12) * 0.13).tolist() for k in range(90)] + [centres[0].tolist()] * 3
    odd = [(200, None), (201, []), (202, [0.0] * 12), (203, [float("nan")] * 12), (204, [None] * 12), (205, [1.0, 2.0]), (206, [2.0, 4.0]), (None, x[0]), (0, x[0])]
    rows = [*enumerate(x), *odd]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, block int, v int")
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in enumerate(x)} | {205: np.array([1, 2]) / 5**0.5, 206: np.array([1, 2]) / 5**0.5}
    near = lambda a, b: len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.95
    want, count = grouped(u, near), {a: sum(near(a, b) for b in u if b != a) for a in u}
    found = gridjoin.embedding_duplicates(table).collect()
    assert len(found) == len(rows)
    for f in found:
        assert f.n_links == count.get(f.vec_id, 0) and f.component_id == want.get(f.vec_id, f.vec_id)
    assert gridjoin.embedding_duplicates(table.limit(0)).count() == 0


def test_mixture_keeps_all_documents_and_limits_repeats(spark, docs):
    rows = mixing.mixture(docs, repeats=2.0).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in ROWS}
    assert all(r.epoch in (0, 1) for r in rows) and len({(r.block, r.place) for r in rows}) == len(rows)
    assert mixing.mixture(docs.limit(0)).count() == 0
    mixed = mixing.mixed_documents(docs, repeats=2.0)
    assert mixed.columns == docs.columns and mixed.count() == len(rows)


def test_temperature_meets_entropy_and_repetition(spark):
    p = np.array([0.7, 0.2, 0.1])
    shares = spark.createDataFrame([(float(x),) for x in p], "p double")
    entropy = lambda a: -sum(w * np.log(w) for w in p**a / sum(p**a))
    assert abs(entropy(mixing.temperature(shares, entropy=0.95)) - 0.95) < 1e-6
    assert abs(7 ** (1 - mixing.temperature(shares, repeats=2.0)) - 2) < 1e-6


def test_pipeline_stages_equal_their_operators(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), sf).count() == 0
    rows = corpus_pipeline.run(spark, sf).collect()
    good = quality.keep_good(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id for r in minhash.keep_one(good).collect()}
    assert {r.doc_id for r in rows} == kept
    for r in rows[:20]:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def templates(n, pairs, seed=6, length=160, own=24):
    """(id, text): one template with words of each document's own after it; the last ones nearly copy some of the others."""
    r = np.random.default_rng(seed)
    words = lambda k: [f"w{x}" for x in r.integers(0, 10**6, k)]
    template = words(length)
    tails = [words(own + int(x)) for x in r.integers(0, 12, n)]
    tails += [[*t[:-1], "changed"] for t in tails[n // 2 : n // 2 + pairs]]
    ids = r.permutation(10 * n)[: n + pairs]
    return [(int(i), " ".join(template + t)) for i, t in zip(ids, tails)]


def all_pairs(rows, words, percent):
    sets = {i: {tuple(t.split()[k : k + words]) for k in range(len(t.split()) - words + 1)} for i, t in rows}
    return grouped(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))


def test_near_duplicates_among_unlinked_templates(spark):
    rows = templates(300, 2)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, bands=4, rows=1).collect()
    want = all_pairs(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in found} == want and len(set(want.values())) == len(rows) - 2


def test_bands_follow_the_threshold():
    for percent in (50, 70, 80, 85, 95):
        bands, rows = minhash.banding(percent)
        assert bands * rows <= minhash.BINS and minhash.missed(percent / 100, bands, rows) <= 1e-5
    assert (minhash.banding(80), minhash.banding(85)) == ((53, 6), (40, 8))
    assert 0.5e-7 < minhash.missed(0.8, 53, 6) < 1.5e-7 and 2.5e-6 < minhash.missed(0.85, 40, 8) < 3.5e-6


def test_windows_hold_whole_addresses():
    names = ("maria.gonzalez", "a.very.long.local.part.of.an.address", "x" * 64)
    for name, at in itertools.product(names, (" @ ", "(@)", "@ ", " [at] ", "(at)", " at ")):
        host = "mail.department dot example dot org" if at == " at " else "mail.department.of.a.university.example.org"
        text = "so please write to " + name + at + host + " before the end of the week"
        a, b = text.index(name), text.index(host) + len(host)
        assert any(s < a and b < e for s, e in pii.windows(text)), text
        assert pii.added_spans(text, [(a, 0, b, 1e3)], []) == [(a, 0, b)]
    long = "see " + "1 " * 3000
    places = pii.windows(long)
    assert all(any(s < a and a + 320 <= e for s, e in places) for a in range(4, 5600))
    assert (pii._tags([(10, 0, 30)], 20)[:11] == [2] * 10 + [0]).all()


def test_network_adds_long_addresses():
    r = np.random.default_rng(7)
    name = lambda: "".join(r.choice([*"abcdefghiklmnoprstu"], r.integers(6, 12)))
    tagger = pii.train([f"please write to {name()}.{name()}.{name()}@{name()}.example.org today" for _ in range(150)], 1000)
    text = "please write to maria.magdalena.gonzalez @ institute.example.org today"
    a, b = text.index("maria"), text.index(" today")
    assert pii.find([text], tagger)[0][1] == [(a, 0, b)]


def test_pieces_of_a_heavy_key_are_split(spark, monkeypatch):
    r = np.random.default_rng(8)
    line = "this line of some forty bytes is frequent"
    rows = [(k, "".join(r.choice([*"abcdefgh"], 60)) + line + "".join(r.choice([*"abc"], 9 if k % 3 else 70))) for k in range(120)]
    rows += [(200 + k, rows[k][1][20:] + "z") for k in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ("doc_id", "n_removed", "n_spans", "kept")
    want = sorted(map(tuple, suffixes.without_repeats(table).select(*columns).collect()))
    batch = pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})
    packed = pa.Table.from_batches(list(suffixes._keys(50, 1)(iter([batch]))))
    monkeypatch.setattr(suffixes, "HEAVY", 2000)
    found = suffixes._shared(packed)
    heavy = np.array(found.filter(pc.is_null(found["doc_id"]))["key"].to_pylist(), np.uint64)
    assert len(heavy)
    keys = pa.array([found["key"].to_pylist()] * len(rows))
    largest = {}
    batch = batch.append_column("keys", keys).append_column("mark", pa.array([0] * len(rows), pa.int64()))
    for split in (heavy, heavy[:0]):
        sieve = np.zeros(suffixes.SIEVE, bool)
        sieve[(split % np.uint64(suffixes.SIEVE)).astype(int)] = True
        out = pa.Table.from_batches(list(suffixes._cut_out(50, 1 << 20, sieve)(iter([batch]))))
        largest[len(split) > 0] = max(n for n, known in zip(out["n"].to_pylist(), out["known"].to_pylist()) if not known)
    # a bucket of one key holds what 2,000 bytes can
    assert largest[True] <= 2000 // 50 < largest[False]
    whole = suffixes.without_repeats
    monkeypatch.setattr(suffixes, "_shared", _all_heavy(suffixes._shared))
    assert sorted(map(tuple, whole(table).select(*columns).collect())) == want and any(w[1] for w in want)


def test_texts_of_one_id_and_hot_copies_against_every_window(spark, monkeypatch):
    """Ids with several texts, copies of whole texts, negative ids; in small chunks also texts longer than a chunk."""
    r = np.random.default_rng(12)
    word = lambda n: "".join(r.choice([*"abcd é"], n))
    lines = [word(n) for n in (60, 90, 140)]
    rows = [(k // 2 - 5, word(30) + lines[k % 3] + word(40)) for k in range(60)]
    rows += [(100 + k, rows[k % 4][1]) for k in range(30)] + [(-5, rows[7][1]), (40, rows[3][1] * 3), (41, lines[0] * 200), (42, lines[0][7:] * 30), (40, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    first = {}
    for i, t in sorted(rows):
        for p in range(len(t.encode()) - 49):
            first.setdefault(t.encode()[p : p + 50], i)
    want = []
    for i, t in rows:
        data = t.encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < i:
                gone[p : p + 50] = True
        want.append((i, len(data), gone.sum(), (np.diff(gone.astype(int)) == -1).sum(), bytes(b for b, g in zip(data, gone) if not g)))
    found = suffixes.without_repeats(table).collect()
    assert sorted((f.doc_id, f.n_bytes, f.n_removed, f.n_spans, bytes(f.kept)) for f in found) == sorted(want)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    keys = suffixes._shared(pa.Table.from_batches(list(suffixes._keys(50, 1)(iter([batch])))))["key"].to_pylist()
    batch = batch.append_column("keys", pa.array([keys] * len(rows))).append_column("mark", pa.array(range(len(rows)), pa.int64()))
    for sieve in (np.zeros(1, bool), np.ones(1, bool)):
        parts = pa.Table.from_batches(list(suffixes._cut_out(50, 1, sieve)(iter([batch]))))
        assert len(parts) > 20
        gone = [np.zeros(w[1] + 1, bool) for w in want]
        for lost in suffixes._first_owner(50)(parts).to_pylist():
            gone[lost["mark"]][lost["a"] : lost["b"]] = True
        assert [g.sum() for g in gone] == [w[2] for w in want]
    assert suffixes.without_repeats(table.limit(0)).collect() == []


def _all_heavy(shared):
    def run(group: pa.Table) -> pa.Table:
        found = shared(group)
        return pa.concat_tables([found, pa.table({"doc_id": pa.nulls(len(found), pa.int64()), "key": found["key"]})])

    return run
