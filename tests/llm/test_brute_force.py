"""The queries that SQL does not express, and the operators' exact parts, against plain Python on a small fixture."""

import re
import zlib

import numpy as np
import pytest
import xxhash

from arborflow.llm import decontaminate, embedding_dedup, html_text, language, licenses, packing, queries, secret_scan, simhash, substring_dedup


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def test_packing_round_trip(spark, sf, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    encoded = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    ids = {i: np.array([*e.ids, 2], "<u4") for i, e in zip(texts, encoded)}
    pieces = queries.op3_harmonic_packing(spark, sf).toPandas()
    for doc_id, own in pieces.sort_values("start").groupby("doc_id"):
        whole = ids.pop(doc_id)
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() == len(whole)
        assert [zlib.crc32(whole[s : s + n]) for s, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
        assert set(own.doc_tokens) == {len(whole)}
    assert not ids
    used = []
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        used.append(int(own.length.sum()))
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in used)
    assert max(used) <= 4096 and padding < 0.03 * sum(used)


@pytest.mark.parametrize("length", [1, 31, 127, 128, 129, 3000, 4095, 4096, 4097, 123_456])
def test_cut_lengths(length):
    pieces = packing.cut_lengths(length)
    assert sum(size for size, _ in pieces) == length
    assert all(0 < size * count <= 4096 for size, count in pieces)


def naive_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def naive_components(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and near(a, b):
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


def test_simhash(spark, sf, texts):
    prints = {i: naive_fingerprint(t) for i, t in texts.items()}
    roots = naive_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, p in prints.items():
        first[roots[p]] = min(i, first.get(roots[p], i))
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in queries.op4_simhash_near_dedup(spark, sf).collect()}
    assert found == {(i, f"{p:016x}", first[roots[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("limit", [8, 8192])
def test_links_of_dense_groups(spark, monkeypatch, limit):
    """Hundreds of fingerprints within a few bits of two centres, and a chain, also when groups are dealt out again."""
    random = np.random.default_rng(1)
    flips = lambda v, n: v ^ sum(1 << int(b) for b in random.choice(64, n, replace=False))
    centres = [int(random.integers(1 << 62)) for _ in range(2)]
    values = {flips(c, random.integers(0, 4)) for c in centres for _ in range(150)}
    chain = [int(random.integers(1 << 62))]
    for _ in range(20):
        chain.append(flips(chain[-1], 4))
    values = {v - (1 << 64) if v >> 63 else v for v in values | set(chain) | {int(x) for x in random.integers(1 << 62, size=200)}}
    monkeypatch.setattr(simhash, "LARGE_GROUP", limit)
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    assert all(near(u, v) for u, v in edges)
    given = {frozenset((u, v)) for u, v in edges}
    own = naive_components(values, lambda a, b: frozenset((a, b)) in given)
    want = naive_components(values, near)
    groups = lambda roots: {frozenset(v for v in values if roots[v] == r) for r in set(roots.values())}
    assert groups(own) == groups(want)


def naive_repeats(texts):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][s : s + 13]), i)
    gone = {i: {p for s in range(len(w) - 12) if first[tuple(w[s : s + 13])] < i for p in range(s, s + 13)} for i, w in words.items()}
    return {(i, len(w), len(gone[i])) for i, w in words.items()}


@pytest.mark.parametrize("flush", [200, 2_000_000])
def test_substrings(documents, texts, monkeypatch, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH_WORDS", flush)
    found = substring_dedup.remove_repeats(documents).collect()
    assert {(r.doc_id, r.n_words, r.n_removed) for r in found} == naive_repeats(texts)
    assert all(sum(b - a for a, b in r.removed) == r.n_removed for r in found)


def test_substrings_at_every_offset(spark):
    """A shared span of just 13 words is found whatever its two places are modulo the period."""
    span = " ".join(f"s{i}" for i in range(13))
    rows = [(a, " ".join([f"a{a}_{i}" for i in range(a)] + [span, f"z{a}"])) for a in range(8)]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.n_removed) for r in found.collect()} == {(a, 13 if a else 0) for a in range(8)}


def test_winnowing_finds_every_window(spark, texts):
    words = item_words(next(t for t in texts.values() if len(t) > 3_000))
    items = [(i, " ".join(words[i : i + n])) for i, n in ((0, 10), (5, 11), (40, 25), (100, 3))]
    docs = [(1, " ".join(words)), (2, " ".join(words[:9])), (3, "x " + " ".join(words[41:51]).upper() + " y"), (4, " ".join(words[101:103]))]
    found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    hits = {r.doc_id: (r.n_hit, r["items"]) for r in found.collect()}
    assert hits[1][0] >= 10 + 6 + 25 and set(hits[1][1]) == {"0", "5", "40", "100"}
    assert hits[2] == (0, []) and hits[3] == (10, ["40"]) and hits[4] == (0, [])


def test_licenses(documents, texts):
    phrases = [(p.split(), label) for p, label in licenses.BASE]
    for row in licenses.scan(documents).collect():
        words = item_words(texts[row.doc_id])
        places = [(s, label) for p, label in phrases for s in range(len(words)) if words[s : s + len(p)] == p]
        starts = [s for s, _ in places]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == sorted({label for _, label in places}) and set(row.base_labels) <= set(row.labels) and 0 <= row.score <= 1


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", ["mit"]),
        ("This is licensed under the terms of the GNU General Public License version 2 or later", ["gpl", "gpl-2.0"]),
        ("GNU Affero General Public License v3", ["agpl-3.0", "gpl"]),
        ("SPDX-License-Identifier: Apache License 2.0", ["apache-2.0"]),
        ("CC BY-SA 4.0 and CC BY 3.0", ["cc-by", "cc-by-sa"]),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", ["mit"]),
        ("a submitted license plate", []),
        ("cc by cc by", ["cc-by"]),
    ],
)
def test_license_rules(spark, text, labels):
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == labels


def test_rules_fit_the_window():
    every = [rule for own in licenses.rules().values() for rule in own]
    assert len(every) > 300
    assert all(len(pattern.split(" ")) + 8 * ("{1,8}" in pattern) <= licenses.WINDOW for _, pattern, *_ in every)


def test_secrets(documents, texts):
    assign = re.compile(secret_scan.ASSIGN, re.A)
    for row in secret_scan.find_secrets(documents).collect():
        text = texts[row.doc_id]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        base = [(s.start, secret_scan.KINDS.index(s.kind), s.end) for s in row.spans if s.kind != "random"]
        assert base == sorted(spans)


def test_random_tokens_stand_out(spark):
    random = np.random.default_rng(4)
    draw = lambda letters, n: "".join(letters[i] for i in random.integers(len(letters), size=n))
    syllables = "the ing an er on tion re ed th in st en at".split()
    words = ["".join(syllables[i] for i in random.integers(len(syllables), size=10))[:30] for _ in range(300)]
    secrets = [draw("abcdef0123456789", 30) for _ in range(10)] + [draw(secret_scan.ENCODINGS[-2][2], 40) for _ in range(10)]
    rows = [(i, f"é😀 {w} 2024") for i, w in enumerate(words)] + [(1000 + i, f"é😀 {s} end") for i, s in enumerate(secrets)] + [(2000, "a" * 25 + "1"), (2001, "token = shortval secret: x password=password=abcdefgh12")]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = sum(found[1000 + i] == [("random", 3, 3 + len(s))] for i, s in enumerate(secrets))
    assert hits >= 18 and not any(found[i] for i in range(300)) and found[2000] == []
    assert [k for k, *_ in found[2001]] == ["assign", "assign"]


def test_language_held_out(spark, sf, documents):
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = [r for r in queries.op10_language_id(spark, sf).collect() if r.held_out and langs[r.doc_id]]
    assert len(rows) > 20 and np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_does_not_see_its_labels(documents):
    """Other labels and ids leave a prediction by a given model as it is."""
    model = language.fit(documents)
    one = language.predict(documents, model).select("text", "lang_pred", "score").collect()
    other = language.predict(documents.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang"), model).select("text", "lang_pred", "score").collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_vectors_recall(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(30, 32))
    near = np.concatenate([c + random.normal(size=(40, 32)) * 0.24 for c in centres])
    vectors = np.concatenate([near, random.normal(size=(400, 32)), near[:20]])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    found = embedding_dedup.near_duplicates(table).toPandas().sort_values("vec_id")
    assert (found.n_links.to_numpy() <= links).all() and found.n_links.sum() >= 0.95 * links.sum() > 1_000


def test_vectors_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", 16)
    random = np.random.default_rng(3)
    vectors = np.ones(16) + random.normal(size=(150, 16)) * 0.05
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = embedding_dedup.near_duplicates(table).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(149, 0)}


def test_extraction_of_made_up_pages():
    field = html_text.trained_field(300)
    random = np.random.default_rng(77)
    same = total = 0
    for _ in range(100):
        page = html_text.labelled_blocks(html_text.labelled_page(random))
        if page:
            labels = field.decode(field.scores([b[:3] for b in page], {}))
            same += sum(a == b[3] for a, b in zip(labels, page))
            total += len(page)
    assert same > 0.99 * total


def test_viterbi_is_the_best_of_all_labellings():
    random = np.random.default_rng(6)
    field = html_text.Field({}, np.zeros((0, 2)), random.normal(size=(2, 2)), random.normal(size=2))
    scores = random.normal(size=(7, 2))

    def value(labels):
        return field.first[labels[0]] + sum(scores[i, x] for i, x in enumerate(labels)) + sum(field.transition[a, b] for a, b in zip(labels, labels[1:]))

    every = [[n >> i & 1 for i in range(7)] for n in range(128)]
    assert field.decode(scores) == max(every, key=value)
    single, _ = html_text._marginals(scores, field)
    weights = np.exp([value(labels) for labels in every])
    assert np.allclose(single[:, 1], (weights[:, None] * np.array(every)).sum(axis=0) / weights.sum())


def test_extraction_of_articles(spark, sf):
    import html as entities

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    same = 0
    rows = html_text.extract(pages).collect()
    for row in rows:
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        same += row.text == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
    assert same >= 0.98 * len(rows)


def test_words_are_tokenized_as_texts_are(monkeypatch):
    """Plain and odd words, through caches that overflow, against the tokenizer on the whole text."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    path = queries.tokenizer_path()
    whole, own = Tokenizer.from_file(path), packing.WordTokens(path, 2)
    odd = "it's IT'S we'll 'tis ''d' a1b2 12,345.67 x--y Straße ÀÉÎ ĮÆ İstanbul ŁÓDŹ ﬁne été 你好 😀! a b c\u0085d ­ <|endoftext|> a<|startoftext|>b ΣΑΣ ½ ² ª º '' '' … “quoted” \x00 \x1c x\x1dy".split(" ")
    random = np.random.default_rng(5)
    letters = list("abcdeABCDEéüßÄñç'’.,!?-0123456789")
    words = odd + ["".join(random.choice(letters, random.integers(1, 12))) for _ in range(500)]
    for at in range(0, len(words), 40):
        part = words[at : at + 40]
        ids, sizes = own.ids([*[w.encode() for w in part], None])
        assert ids.tolist() == [*whole.encode(" ".join(part), add_special_tokens=False).ids, 2] and sizes[-1] == 1


def test_packing_holds_numbers_and_the_most_used_words(monkeypatch):
    """A task holds a number for each word of its part, not the word; the cache stays bounded and keeps what is used."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    import pyspark
    from tokenizers import Tokenizer

    random = np.random.default_rng(7)
    path = queries.tokenizer_path()
    used = [f"used{i}" for i in range(50)]
    monkeypatch.setattr(packing, "CACHE_WORDS", 400)
    whole, own = Tokenizer.from_file(path), packing.WordTokens(path, 2)
    for turn in range(30):
        words = used + [f"rare{random.integers(1 << 40)}," for _ in range(100)]
        ids, _ = own.ids([*[w.encode() for w in words], None])
        assert ids.tolist() == [*whole.encode(" ".join(words), add_special_tokens=False).ids, 2]
        assert len(own.places) <= 400 and {w.encode() for w in used} <= set(own.places)

    monkeypatch.undo()
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(random.choice(used, 5000)) for _ in range(250)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": range(at, at + 10), "text": texts[at : at + 10]}) for at in range(0, 250, 10)]
    tracemalloc.start()
    pieces = [row for out in packing._packer(path, 4096, 2, 1 / 32)(iter(batches)) for row in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45e6 and sum(p["length"] for p in pieces) == sum(len(e.ids) + 1 for e in whole.encode_batch_fast(texts, add_special_tokens=False))


def test_rejection_is_calibrated(spark, documents):
    """Shuffled texts and an unknown language go, held-out labelled texts stay; rows of one id are drawn by their texts."""
    model = language.fit(documents)
    kept, left_out, shuffled = model.shares
    assert kept <= 0.01 and left_out >= 0.8 and shuffled >= 0.95
    random = np.random.default_rng(1)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    junk = [(i, " ".join("".join(random.choice(letters, random.integers(3, 9))) for _ in range(60))) for i in range(40)]
    found = language.predict(spark.createDataFrame(junk, "doc_id long, text string"), model).collect()
    assert sum(r.rejected for r in found) >= 38
    same = language.fit(documents.selectExpr("1 as doc_id", "text", "lang"))
    assert same.languages == model.languages
