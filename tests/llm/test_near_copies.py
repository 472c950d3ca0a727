"""Near copies against all pairs, where nearer texts or large groups stand between the texts of a link."""

from itertools import combinations

from arborflow.llm import near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def wanted(texts):
    """Smallest id of each text's component, from the Jaccard similarity of all pairs."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def replaced(words, at, size, name):
    return words[:at] + [f"{name}x{k}" for k in range(size)] + words[at + size :]


def family(seed):
    """Two linked texts, each among 24 that are about as near by their fingerprints but less similar."""
    one = [f"{seed}w{k}" for k in range(204)]
    two = replaced(one, 93, 18, f"{seed}two")
    ways = [replaced(words, start + 3 * k, 19, f"{seed}{name}{k}") for name, words, start in (("a", one, 5), ("b", two, 112)) for k in range(24)]
    return [" ".join(t) for t in (one, two, *ways)]


def test_link_behind_nearer_texts(spark):
    texts = family(1)
    want = wanted(texts)
    assert want[1] == 0 and want.count(0) == 2
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert [r.component_id for r in near_copies.near_copies(rows.coalesce(1)).orderBy("doc_id").collect()] == want


def test_any_two_texts_of_a_large_group_meet(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "LARGE_GROUP", 2)
    monkeypatch.setattr(near_copies, "LONGER", (0,))
    monkeypatch.setattr(near_copies, "ANCHORS", 0, raising=False)
    nodes = spark.range(12).selectExpr("cast(cast(id as string) as binary) as node", "7L as f0", "8L as f1", "9L as f2", "10L as f3").coalesce(1)
    dealt = near_copies._dealt(nodes, 12, near_copies._large_groups(nodes, 12)).select("key", "node").collect()
    groups = {}
    for key, node in dealt:
        groups.setdefault(key, set()).add(int(node))
    met = {pair for group in groups.values() for pair in combinations(sorted(group), 2)}
    assert met == set(combinations(range(12), 2)) and max(map(len, groups.values())) < 12


def test_pairs_are_compared_once(spark, monkeypatch):
    """Texts that are near but all less similar: whichever end names a pair, it is compared once, in few rounds."""
    words = [f"w{k}" for k in range(204)]
    texts = [" ".join(replaced(words, 3 + 9 * k, 14, f"n{k}")) for k in range(20)]
    assert wanted(texts) == list(range(20))
    compared, rounds = [], []
    judge, propose = near_copies._compared, near_copies._proposed

    def judged(pairs, sets):
        compared.extend(frozenset((bytes(r.u), bytes(r.v))) for r in pairs.select("u", "v").collect())
        return judge(pairs, sets)

    monkeypatch.setattr(near_copies, "_compared", judged)
    monkeypatch.setattr(near_copies, "_proposed", lambda most: rounds.append(most) or propose(most))
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    found = near_copies.near_copies(rows.coalesce(1)).orderBy("doc_id").collect()
    assert [r.component_id for r in found] == list(range(20))
    assert len(compared) > 50 and len(set(compared)) == len(compared)
    assert len(rounds) <= 5
