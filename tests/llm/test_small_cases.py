"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from arborflow.llm import decontaminate, embedding_dedup, html_text, language, licenses, line_dedup, packing, secret_scan, simhash, substring_dedup  # noqa: E402
from arborflow.llm.queries import tokenizer_path  # noqa: E402

LONG = "long words stand here " * 20_000
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, " \n\t\n ", None, "a", 5),
    (4, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a", 80),
    (4, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a", 80),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "b", 80),
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", None, None, None),
    (6, LONG, "en", "c", len(LONG)),
    (7, "!!! ??? 123", "en", "c", 11),
    (8, "ñandú über Straße 你好 Ωmega 😀 á", "es", "c", 30),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "fp long, key long, rank long, content string, row long, hash long, u long, v long, word string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "ONE two, three four five six seven eight nine ten"), (1, "one two three four five six seven eight nine ten"), (2, None), (3, "..."), (4, "über!"), (None, "123")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(benchmark):
    return {
        "licenses": licenses.scan,
        "packing": lambda d: packing.pack(d, tokenizer_path()),
        "simhash": simhash.near_duplicates,
        "lines": line_dedup.remove_repeated_lines,
        "secrets": secret_scan.find_secrets,
        "decontaminate": lambda d: decontaminate.contamination(d, benchmark),
        "substrings": substring_dedup.remove_repeats,
        "language": lambda d: language.predict(d, language.fit(d)),
    }


@pytest.mark.parametrize("name", ["licenses", "packing", "simhash", "lines", "secrets", "decontaminate", "substrings", "language"])
def test_any_table(spark, docs, benchmark, name):
    run = operators(benchmark)[name]
    plain = run(docs)
    ids = sorted(str(r["doc_id"]) for r in plain.select("doc_id").collect())
    if name == "packing":
        assert set(ids) == {str(r[0]) for r in ROWS}
    else:
        assert ids == sorted(str(r[0]) for r in ROWS)
    for columns in EXTRA.split(", "):
        column, kind = columns.split()
        docs = docs.selectExpr("*", f"cast(doc_id as {kind}) as {column}")
    crowded = run(docs)
    names = [c for c in plain.columns if c != "sequence_id"]
    assert sorted(map(str, crowded.select(names).collect())) == sorted(map(str, plain.select(names).collect())) or name == "packing"
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_text_results(spark, docs, benchmark):
    row = {name: run(docs).where("doc_id = 1").first() for name, run in operators(benchmark).items()}
    assert (row["licenses"].n_words, row["licenses"].first_word, row["licenses"].labels, row["licenses"].score) == (0, None, [], 0.0)
    assert (row["packing"].length, row["packing"].doc_tokens) == (1, 1)
    assert (row["simhash"].fingerprint, row["simhash"].component_id) == ("0" * 16, 1)
    assert (row["lines"].text, row["lines"].n_lines) == (None, 0)
    assert row["secrets"].spans == []
    assert (row["decontaminate"].n_words, row["decontaminate"].contaminated) == (0, False)
    assert (row["substrings"].n_words, row["substrings"].n_removed) == (0, 0)
    assert (row["language"].lang_pred, row["language"].score, row["language"].rejected) == ("und", 0.0, True)


def test_repeated_rows_and_null_ids(docs, benchmark):
    removed = {(r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(docs).where("n_words = 14").collect()}
    assert removed == {(4, 0), (5, 14), (None, 14)}
    linked = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).where("doc_id in (3, 4, 5) or doc_id is null").collect()}
    assert linked == {(3, 1), (4, 4), (5, 4), (None, 4)}
    hits = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.contamination(docs, benchmark).collect()}
    assert hits[4] == hits[5] == (10, ["1"]) and hits[8] == (1, ["4"]) and hits[7] == (1, [])


def test_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<html><nav>x</nav></html>"), (4, "u", "no markup"), (4, "u", "<p"), (5, "u", "<article><p>A &amp; B\n c." + "<p>word word word.</p>" * 5_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "page_id as text", "url as seen")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "html", "seen", "text"]
    texts = {r.page_id: r.text for r in found.where("page_id <> 4").collect()}
    assert texts[1] == texts[2] == "" and texts[5].startswith("A & B c. word") and texts[5].count("word") == 15_000
    assert found.count() == 6 and html_text.extract(pages.limit(0)).count() == 0


def test_vectors(spark):
    near = [1.0, 0.0, 0.1]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [1.0, 0.0, 0.0]), (6, [1.0, 0.0, 0.0]), (7, near), (8, [2.0, 0.0, 0.0]), (9, [-1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (None, [0.0, 1.0, 0.0]), (11, [1e300, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as node", "vec_id as u")
    found = embedding_dedup.near_duplicates(table)
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in found.collect())
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 9, 10)] + [(6, 4, 6, True)] * 2 + [(i, 4, 6, False) for i in (7, 8, 11)] + [(None, 0, None, False)]
    assert got == sorted((str(a), b, c, d) for a, b, c, d in want)
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["double", "float"])
def test_vectors_without_ids_and_of_one_id(spark, kind):
    """Rows are judged by their vectors: a missing id hides none, a shared one adds no links."""
    rows = [(None, [1.0, 0.0, 0.01]), (1, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (4, [0.0, 0.99, 0.1]), (7, [0.0, 1.0, 0.05]), (9, [0.0, 0.0, 1.0]), (9, [0.0, 0.0, -1.0]), (None, [-1.0, 0.0, 0.0]), (None, [-1.0, 0.0, 0.0])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"))
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()]
    want = [(None, 1, 1, False), (1, 1, 1, True), (4, 2, 4, True), (4, 2, 4, True), (7, 2, 4, False), (9, 0, 9, True), (9, 0, 9, True), (None, 1, None, False), (None, 1, None, False)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_pipeline_stages(spark, docs, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, spark.createDataFrame([], SCHEMA)):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, str(tmp_path)).columns == rows.columns, name
        pieces = corpus_pipeline.run(spark, str(tmp_path))
        assert {r.doc_id for r in pieces.select("doc_id").collect()} == ({6} if rows is docs else set())


def test_language_stage_keeps_what_has_letters(spark, docs):
    kept = corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()
    assert {r.doc_id for r in kept} >= {4, 5, 6, None} and not {r.doc_id for r in kept} & {1, 2, 3, 7}
