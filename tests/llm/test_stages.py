"""Stages of the pipeline against brute force: repeated line runs, near copies."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def without_repeated_runs(texts):
    """texts by ascending id; every run of two or more lines is looked for at every earlier place."""
    seen, kept = [], []
    for text in texts:
        lines, gone = text.split("\n"), set()
        for start in range(len(lines)):
            for size in range(2, len(lines) - start + 1):
                run = lines[start : start + size]
                earlier = [*seen, lines[:start]]
                if any(own[i : i + size] == run for own in earlier for i in range(len(own) - size + 1)) and "".join(run).strip():
                    gone.update(range(start, start + size))
        seen.append(lines)
        kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
    return kept


def test_line_stage_takes_every_repeated_run(spark):
    draw = random.Random(3)
    passages = [[f"passage {p} line {i}" for i in range(draw.randint(2, 5))] for p in range(12)]
    texts = []
    for d in range(60):
        lines = []
        for part in range(draw.randint(1, 4)):
            lines += [f"own {d} {part} {i}" for i in range(draw.randint(0, 3))] + draw.choice(passages)
        texts.append("\n".join(lines))
    texts += [texts[5], "a\na\na\na\na", "a\na\na", " \n\n \n\nx", " \n\n \n\ny", "one line", "one line", "", texts[6] + "\n" + texts[6]]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()}
    assert [found[i].text for i in range(len(texts))] == without_repeated_runs(texts)
    assert all(r.n_chars == len(r.text) for r in found.values())


def naive_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copy_stage_reaches_jaccard_of_0_8(spark):
    """Copies with words replaced, at similarities around 0.8, and chains of them; compared with every pair."""
    draw = random.Random(5)
    texts = []
    for _ in range(60):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(60, 300))]
        texts.append(" ".join(words))
        for _ in range(draw.randint(0, 3)):
            words = [w if draw.random() > draw.choice((0.005, 0.015, 0.02, 0.03)) else f"x{draw.randrange(5000)}" for w in words]
            texts.append(" ".join(words))
    texts += [texts[0].upper(), "a b", "a  b", "a c", ""]
    sets = [naive_shingles(t) for t in texts]
    root, linked = list(range(len(texts))), 0
    for j in range(len(texts)):
        for i in range(j):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                linked += 1
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    want = {i for i in range(len(texts)) if root[i] == i}
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in corpus_pipeline.dedup_near_copies(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()}
    assert linked > 40 and want <= kept and len(kept - want) <= 0.02 * (len(texts) - len(want))


def test_memory_of_the_operator_before_goes_back():
    """Blocks that lie below one still in use are given back to the system too."""
    import numpy as np
    import psutil

    from arborflow.llm import common

    used = lambda: psutil.Process().memory_info().rss >> 20
    common.worker_cache("one operator")
    held = [np.ones(10_000) for _ in range(4000)]
    top, full = held[-1], used()
    held.clear()
    common.worker_cache("the next")
    assert used() < full - 200 and len(top) == 10_000


def test_texts_go_to_python_in_small_batches(spark):
    """Also after a stage returned, as results are lazy: 24 MB of texts, in one partition."""
    import pyarrow as pa

    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 60, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 36000) as text", "'en' as lang", "'s' as source", "396000L as n_chars")
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches)
    spark.conf.unset(conf)
    pieces = corpus_pipeline.pack_sequences(spark, texts, "")
    largest = texts.mapInArrow(sizes, "size long").groupBy().max("size").first()[0]
    spark.conf.unset(conf)
    assert largest < 6e6 and pieces.select("doc_id").distinct().count() == 60
