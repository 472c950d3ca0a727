"""The gated license scan against its rules without anchors and keywords, on spellings made from every rule."""

import random
import re
from itertools import islice, product

import pytest

from arborflow.llm import licenses


def spellings(tree):
    """Texts that a parsed expression matches; any digit or letter class gives all of its members, a repeat its bounds."""
    options = []
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            options.append([chr(value)])
        elif name == "IN":
            members = [c for k, v in value for c in ([chr(v)] if str(k) == "LITERAL" else map(chr, range(v[0], v[1] + 1)) if str(k) == "RANGE" else "x7"[str(v) == "CATEGORY_DIGIT"])]
            options.append(members)
        elif name == "SUBPATTERN":
            options.append(list(spellings(value[-1])))
        elif name == "BRANCH":
            options.append([s for branch in value[1] for s in spellings(branch)])
        elif name == "MAX_REPEAT":
            low, high, inner = value
            once = list(spellings(inner))
            options.append([*([""] if low == 0 else []), *once])
        else:
            raise AssertionError(name)
    return map("".join, product(*options))


def test_every_spelling_passes_the_gate():
    rules = licenses.rules()
    stated = [(label, pattern) for *_, label, pattern in [*licenses.SENTENCES, *licenses._texts(), *licenses.NAMES, *licenses._titles()]]
    stated += [(label, f"spdx license identifier {name}") for _, label, name in licenses._identifiers()]
    assert len({pattern for _, pattern in stated}) > 500
    missed = set()
    for label, pattern in stated:
        for text in islice(spellings(re._parser.parse(pattern)), 500):
            assert re.match(f"^{pattern}(?= )", text + " ")
            own = rules.get(text.split(" ")[0], [])
            if not any(r[1] and r[2] == label and licenses._keyword(r[0]) in f" {text} " and re.match(r[1], text + " ") for r in own):
                missed.add((label, text))
    assert not missed, sorted(missed)[:20]


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under the GNU GPLv3", ["gpl-3.0"]),
        ("under GPL2, or LGPLv3", ["gpl-2.0", "lgpl"]),
        ("AGPLv3", ["agpl"]),
        ("the FreeBSD license", ["bsd-2-clause"]),
        ("Creative Commons Attribution Share Alike", ["cc-by-sa"]),
        ("Creative Commons Attribution Non-Commercial No Derivatives", ["cc-by-nc-nd"]),
        ("Creative Commons Attribution NonCommercial Share Alike", ["cc-by-nc-sa"]),
    ],
)
def test_license_spellings(spark, text, labels):
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels == labels


def naive_scan(text):
    """Every rule at every word, without anchors, keywords or windows; finds inside a find of at least their priority go."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    finds = set()
    for start in range(len(words)):
        rest = " ".join(words[start:]) + " "
        for pattern, label, priority, weight in RULES:
            if found := pattern.match(rest):
                finds.add((start, start + found[0].count(" ") + 1, priority, label, weight))
    kept = []
    for start, end, priority, label, weight in sorted(finds, key=lambda f: (f[0], -f[1], *f[2:])):
        if not any(s <= start and end <= e and p <= priority for s, e, p, *_ in kept):
            kept.append((start, end, priority, label, weight))
    base = {label for phrase, label in licenses.BASE if f" {phrase} " in f" {' '.join(words)} "}
    return sorted(base | {label for *_, label, _ in kept}), max([w for *_, w in kept] + [0.5 if base else 0.0]), len(kept)


RULES = sorted({(re.compile(pattern), label, priority, weight) for own in licenses.rules().values() for _, pattern, label, priority, weight in own}, key=lambda r: (r[0].pattern, *r[1:]))


def test_priority_and_containment(spark, sf):
    """Texts joined from spellings of all kinds of rules, and documents, against the rules tried everywhere."""
    draw = random.Random(4)
    stated = [pattern for *_, pattern in [*licenses.SENTENCES, *licenses._texts(), *licenses.NAMES, *licenses._titles()]] + [name for *_, name in licenses._identifiers()]
    pieces = [next(islice(spellings(re._parser.parse(p)), draw.randint(0, 3), None), p.split("(")[0]) for p in stated]
    leads = ["Licensed under the terms of the", "released under the", "SPDX-License-Identifier:", "License:", "under the", "see the license", "copyright (c) 2020", "all rights reserved", "x", "y z"]
    texts = [" ".join(draw.choice(leads if draw.random() < 0.4 else pieces) for _ in range(draw.randint(1, 5))) for _ in range(120)]
    texts += [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(12).collect()]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: (r.labels, r.score, r.n_found) for r in rows} == {i: naive_scan(t) for i, t in enumerate(texts)}
