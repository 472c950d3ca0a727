"""Collocations, vector search and periodic runs against brute force, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arborflow.llm import collocations, periodic_runs, queries, vector_tree
from arborflow.llm import vectors as vectors_of


def naive_collocations(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for size in range(1, 6):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, own in counts.items():
        often = {p: c for p, c in own.items() if c >= least and len(p) > 1}
        held = set()
        for p, c in often.items():
            for size in range(2, len(p)):
                held |= {p[i : i + size] for i in range(len(p) - size + 1) if c >= own[p[i : i + size]]}
        found = []
        for p, a in often.items():
            if p not in held:
                score, k = min((1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])}
    return out


@pytest.mark.parametrize("held, ranked", [(1_000_000, 50_000), (50, 3)])
def test_collocations(spark, monkeypatch, held, ranked):
    monkeypatch.setattr(collocations, "HELD_WORDS", held)
    monkeypatch.setattr(collocations, "RANKED", ranked)
    draw = random.Random(2)
    words = "A b c d É \x00 a.b x,y new york city".split(" ")
    rows = [(draw.choice(["en", "de", None, "und"]), draw.choice([" ", "\t", "  "]).join(draw.choice(words) for _ in range(draw.randint(0, 40))) + draw.choice(["", ". new york\n", "\r\x0bnew york city!"])) for _ in range(300)]
    rows += [("en", None), (None, ""), ("fr", " \t\n"), ("en", "new york city " * 500), *rows[:20]]
    table = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "lang as phrase", "1 as f", "2 as n", "text as part").repartition(4)
    found = collocations.collocations(table, least=8, top=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = naive_collocations(rows, 8, 40)
    assert len(want) > 60 and {tuple(r) for r in found.collect()} == want
    assert collocations.collocations(table.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    grams = spark.createDataFrame([("x", "a", 1, 3 * 10**15), ("x", "b", 1, 7 * 10**15), ("x", "a b", 2, 3 * 10**15 - 1)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("x", 10**17 + 3)], "lang string, n long")
    monkeypatch.setattr(collocations, "count_streams", lambda *a: (grams, totals))
    row = collocations.collocations(spark.createDataFrame([], "lang string, text string")).first()
    assert row.score == 1000 * (3 * 10**15 - 1) * (10**17 + 3) // (3 * 10**15 * 7 * 10**15)


def naive_nearest(ids, vectors, near=5):
    usable = [i for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)]
    unit = vectors_of.units(np.array([vectors[i] for i in usable], float))
    cosine = unit @ unit.T
    out = {}
    for a, i in enumerate(usable):
        if ids[i] is not None and ids[i] % 50 == 0:
            order = sorted((-round(cosine[a, b], 12), ids[j]) for b, j in enumerate(usable) if j != i)
            out.setdefault(ids[i], []).append(order[:near])
    return out


def test_vector_search_recall(spark, monkeypatch):
    """A tree of many leaves, with tiles, groups of copies and repeated ids."""
    monkeypatch.setattr(vector_tree, "LEAF_ROWS", 64)
    monkeypatch.setattr(vector_tree, "TILE_ROWS", 32)
    monkeypatch.setattr(vector_tree, "HELD_QUERIES", 10)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(60, 24))
    vectors = np.concatenate([(centres[draw.integers(60, size=4_000)] + 0.4 * draw.normal(size=(4_000, 24))), np.repeat(centres[:2], 300, axis=0)])
    vectors = vectors.astype(np.float32).astype(float).tolist()
    ids = [i if i % 97 else 50 for i in range(len(vectors))]
    table = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>").selectExpr("*", "vec_id as node", "1 as leaf").repartition(5)
    found = {}
    for r in vector_tree.search(table, table["vec_id"] % 50 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, -round(r.score, 12), r.vec_id))
    want = naive_nearest(ids, vectors)
    assert found.keys() == want.keys()
    hits = total = 0
    for i, lists in want.items():
        assert sorted(r for r, *_ in found[i]) == sorted(list(range(1, 6)) * len(lists))
        truth, got = Counter(x for own in lists for x in own), Counter((s, v) for _, s, v in found[i])
        hits += (truth & got).total()
        total += truth.total()
    assert hits >= 0.95 * total
    # The query of a copied point names the smallest ids among the copies.
    assert sorted(found[4_000])[:5] == [(k + 1, s, v) for k, (s, v) in enumerate(want[4_000][0])]


def test_vector_search_on_odd_tables(spark):
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [1.0, 0.0]), (1, [0.0, 1e300]), (2, None), (100, [0.0, 0.0]), (150, [None, 1.0]), (200, [float("inf"), 1.0]), (250, []), (300, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_tree.search(table, table["vec_id"] % 50 == 0)
    got = sorted((r.query_id, r.rank, str(r.vec_id), round(r.score, 9)) for r in found.collect())
    assert got == sorted(
        [(0, 1, "50", 1), (0, 2, "50", 1), (0, 3, "None", 1), (0, 4, "1", 0), (50, 1, "0", 1), (50, 2, "50", 1), (50, 3, "None", 1), (50, 4, "1", 0), (50, 1, "0", 1), (50, 2, "50", 1), (50, 3, "None", 1), (50, 4, "1", 0)]
    )
    for empty in (table.limit(0), table.where("vec_id = 2")):
        assert vector_tree.search(empty, empty["vec_id"] % 50 == 0).count() == 0


def naive_runs(words, shortest=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(shortest, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def repetitive(draw):
    words = []
    for _ in range(draw.randint(1, 5)):
        base = [draw.choice("abc") for _ in range(draw.randint(1, 12))]
        words += base * draw.randint(1, 6) + base[: draw.randint(0, len(base))]
        words += [draw.choice("abcdefgh") for _ in range(draw.randint(0, 6))]
    return words


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs_of_sequences(shortest):
    draw = random.Random(shortest)
    for _ in range(500):
        words = repetitive(draw) if draw.random() < 0.7 else [draw.choice("ab") for _ in range(draw.randint(0, 60))]
        (found,) = periodic_runs._search([[w.encode() for w in words]], shortest)
        want = [r for r in naive_runs(words, shortest)]
        assert sorted(found) == sorted(want), words


def test_runs_of_special_words():
    """Fibonacci words have most runs; a power of one word is one run."""
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    for words in (b, ["a"] * 1_000, (["a"] * 20 + ["b"]) * 30, ["a", "b"] * 300 + ["a"] * 40):
        (found,) = periodic_runs._search([[w.encode() for w in words]], 12)
        assert sorted(found) == naive_runs(words)


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_runs_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert len(found) == len(docs)
    some = 0
    for doc in docs:
        words, row = planted(doc.doc_id, doc.text), found[doc.doc_id]
        runs = sorted(naive_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        assert row.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row.collapsed_sha256 == digest(" ".join(w for i, w in enumerate(words) if i not in gone))
        some += len(runs)
    assert some > 10


@pytest.mark.parametrize("held", [10, 500_000])
def test_runs_on_odd_tables(spark, monkeypatch, held):
    monkeypatch.setattr(periodic_runs, "HELD_WORDS", held)
    once = "x " + "a b c " * 5 + "y"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, once), (4, once), (None, "é😀 " * 13), (5, "a " * 11), (6, "long words stand here " * 20_000), (7, "one two three")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as n_words", "text as runs", "struct(doc_id) as `odd name`").repartition(3)
    found = periodic_runs.find_runs(table)
    assert found.columns == ["doc_id", "odd name", "n_words", "runs", "collapsed"]
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    ordinary = [("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""), ("5", 11, [], " ".join("a" * 11)), ("7", 3, [], "one two three")]
    assert got == sorted([*ordinary, *[("4", 17, [(1, 15, 3)], "x a b c y")] * 2, ("None", 13, [(0, 13, 1)], "é😀"), ("6", 80_000, [(0, 80_000, 4)], "long words stand here")])
    assert periodic_runs.find_runs(table.limit(0)).count() == 0
