"""Graph extraction on small sources with known node and edge counts."""

import ast
import random

import pytest

from arborflow.functions import ids
from arborflow.operators import calls, graph
from arborflow.operators.flatten import _call_text, flatten
from arborflow.sources.files import identify
from pyspark.sql import functions as F

SOURCES = {
    "chain": "first = 3\nsecond = first + first\nthird = second\n",
    "overwritten": "n = 5\nn = n\nm = n\nn = m\n",
    "choice": "def pick(flag):\n    if flag:\n        out = 'a'\n    elif not flag:\n        out = 'b'\n    return out\n",
    "countdown": "left = 4\nwhile left:\n    left -= 1\n",
    "library": "import json as j\nfrom os.path import join, split\nj.dumps(join('a', 'b'))\nsplit(j)\n",
    "helpers": "def low(v):\n    return v\n\ndef high(v):\n    w = low(v)\n    return low(w)\n\nhigh(high(1))\n",
    "shielded": "try:\n    risky()\nfinally:\n    done = True\nprint(done)\n",
    "kinds": "class Box:\n    def put(self, item):\n        self.item = item\n\nasync def wait(box):\n    async with box as b:\n        return b[0]()\n",
    "empty": "",
    "broken": "values = [1, 2\nprint(values)\n",
    "null": "a = 1\0",
}
# snippet: scope nodes, external symbols, edges by type beside AST_CHILD; worked out by hand (nothing leads into a return)
EXPECTED = {
    "chain": (2, 0, {"CFG_NEXT": 4, "DFG_DEF_USE": 3}),
    "overwritten": (2, 0, {"CFG_NEXT": 5, "DFG_DEF_USE": 3}),
    "choice": (4, 0, {"CFG_NEXT": 3, "CFG_TRUE": 2, "CFG_FALSE": 1, "CFG_RETURN": 1, "DFG_DEF_USE": 4}),
    "countdown": (2, 0, {"CFG_NEXT": 3, "CFG_LOOP_BODY": 1, "CFG_LOOP_BACK": 1, "CFG_LOOP_EXIT": 1, "DFG_DEF_USE": 2}),
    "library": (2, 3, {"CFG_NEXT": 5, "CALLS": 3}),
    "helpers": (6, 0, {"CFG_NEXT": 5, "CFG_RETURN": 2, "DFG_DEF_USE": 5, "CALLS": 4}),
    "shielded": (2, 2, {"CFG_NEXT": 3, "DFG_DEF_USE": 1, "CALLS": 2}),
    "kinds": (6, 0, {"CFG_NEXT": 7, "DFG_DEF_USE": 4}),
    "empty": (0, 0, {}),
}


def sources_of(spark, texts):
    rows = [(f"{name}.py", bytearray(text.encode()), None) for name, text in texts.items()]
    return identify(spark.createDataFrame(rows, "file_path string, content binary, read_error string"), "demo")


@pytest.fixture(scope="module")
def built(spark):
    sources = sources_of(spark, SOURCES).persist()
    flat = flatten(sources, counted=True).persist()
    names = {r.file_id: r.file_path[:-3] for r in sources.collect()}
    return sources, flat, graph.build_graph(sources, flat), names


def test_counts(built):
    _, _, made, names = built
    nodes = {names[r.file_id]: r["count"] for r in made.nodes.groupBy("file_id").count().collect()}
    edges = {}
    for r in made.edges.groupBy("file_id", "edge_type").count().collect():
        edges.setdefault(names[r.file_id], {})[r.edge_type] = r["count"]
    for name, (scopes, external, others) in EXPECTED.items():
        syntax = sum(1 for _ in ast.walk(ast.parse(SOURCES[name])))
        assert nodes[name] == syntax + scopes + external, name
        want = dict(others) | ({"AST_CHILD": syntax - 1} if syntax > 1 else {})
        assert edges.get(name, {}) == want, name
    assert not {"broken", "null"} & set(nodes)


def test_ids_are_unique_and_connected(built):
    _, _, made, _ = built
    assert made.nodes.count() == made.nodes.select("node_id").distinct().count()
    assert made.edges.count() == made.edges.select("edge_id").distinct().count()
    ends = made.edges.select(F.explode(F.array("source_id", "target_id")).alias("node_id"))
    assert ends.join(made.nodes, "node_id", "left_anti").count() == 0


def test_statistics_and_errors(built):
    _, _, made, names = built
    stats = {names[r.file_id]: r for r in made.metadata.collect()}
    assert (stats["helpers"].function_count, stats["helpers"].line_count) == (2, 8)
    assert (stats["kinds"].function_count, stats["kinds"].class_count) == (2, 1)
    assert stats["library"].import_count == 3
    assert (stats["empty"].line_count, stats["empty"].size_bytes, stats["empty"].edge_count) == (0, 0, 0)
    assert set(stats) == set(EXPECTED)
    errors = {names[r.file_id]: r.message for r in made.errors.collect()}
    assert set(errors) == {"broken", "null"} and errors["broken"].startswith("SyntaxError in broken.py: ")


def nested(pick, depth=0, loop=False):
    """Lines of random nested statements: branches, loops with and without else, jumps, definitions, calls."""
    out = []
    for _ in range(pick.randint(1, 4)):
        kind = pick.choice(["x = y", "y = x + z", "z += x", "f(x)", "m.g(f(y))", "pass", "if", "if", "while", "for", "def", "class", "try", "with", *(["return x"] if depth else []), *(["break", "continue"] if loop else [])])
        inner = lambda loop=loop: ["    " + line for line in (nested(pick, depth + 1, loop) if depth < 4 else ["x = 1"])]
        if kind == "if":
            out += ["if x:", *inner(), *(["elif y:", *inner()] if pick.random() < 0.3 else []), *(["else:", *inner()] if pick.random() < 0.5 else [])]
        elif kind in ("while", "for"):
            out += ["while x:" if kind == "while" else "for x in z:", *inner(True), *(["else:", *inner()] if pick.random() < 0.2 else [])]
        elif kind in ("def", "class"):
            out += ["def f(x, w=1):" if kind == "def" else "class K:", *inner(False)]
        elif kind in ("try", "with"):
            out += [*(["try:", *inner(), "except E as y:", *inner(), "finally:", *inner()] if kind == "try" else ["with f(x) as y:", *inner()])]
        else:
            out.append(kind)
    return out


def test_statistics_count_what_is_built(spark):
    texts = {f"t{seed}": "import m\nfrom q import f as g\n" + "\n".join(nested(random.Random(seed))) + "\n" for seed in range(300)}
    texts = {name: text for name, text in texts.items() if parses(text)}
    sources = sources_of(spark, texts)
    made = graph.build_graph(sources, flatten(sources, counted=True).persist())
    stats = {r.file_id: (r.node_count, r.edge_count) for r in made.metadata.collect()}
    nodes = {r.file_id: r["count"] for r in made.nodes.groupBy("file_id").count().collect()}
    edges = {r.file_id: r["count"] for r in made.edges.groupBy("file_id").count().collect()}
    assert len(stats) > 150 and stats == {f: (n, edges[f]) for f, n in nodes.items()}


def parses(text):
    try:
        ast.parse(text)
    except SyntaxError:
        return False
    return True


def test_call_resolution(built):
    _, flat, _, names = built
    found = {
        (names[r.file_id], r.call_text): (r.resolution_type, r.qualified_name)
        for r in calls.resolve_calls(flat).collect()
    }
    assert found["helpers", "low"] == ("LOCAL_FUNCTION", "low")
    assert found["library", "join"] == ("IMPORTED_SYMBOL", "os.path.join")
    assert found["library", "j.dumps"] == ("IMPORTED_MODULE_ATTRIBUTE", "json.dumps")
    assert found["shielded", "print"] == ("UNRESOLVED_DYNAMIC_CALL", "print")


@pytest.mark.parametrize("call, text", [("f()", "f"), ("a.b.c()", "a.b.c"), ("f()()", None), ("f().g.h()", None), ("x[0].y.z()", "y.z"), ("x[0]()", None)])
def test_call_text(call, text):
    assert _call_text(ast.parse(call).body[0].value) == text


def edges_of(spark, text, edge_type):
    """{(source path, target path)} of one snippet."""
    flat = flatten(sources_of(spark, {"one": text}))
    made = graph.graph_nodes(flat).select("node_id", "ast_path")
    rows = graph.graph_edges(flat).where(F.col("edge_type").startswith(edge_type))
    rows = rows.join(made.toDF("source_id", "s"), "source_id").join(made.toDF("target_id", "t"), "target_id")
    return sorted((r.edge_type, r.s.replace("Module.", ""), r.t.replace("Module.", "")) for r in rows.collect())


def test_control_flow_of_loops(spark):
    text = "for i in x:\n    if i:\n        continue\n    elif y:\n        break\n    z = i\nelse:\n    q = 1\nend = 1\n"
    assert edges_of(spark, text, "CFG") == sorted(
        [
            ("CFG_NEXT", "entry", "body[0]"),
            ("CFG_LOOP_BODY", "body[0]", "body[0].body[0]"),
            ("CFG_LOOP_EXIT", "body[0]", "body[1]"),
            ("CFG_LOOP_BACK", "body[0].body[1]", "body[0]"),
            ("CFG_NEXT", "body[0].body[1]", "body[0]"),
            ("CFG_FALSE", "body[0].body[0]", "body[0].body[0].orelse[0]"),
            ("CFG_LOOP_BACK", "body[0].body[0].body[0]", "body[1]"),
            ("CFG_FALSE", "body[0].body[0].orelse[0]", "body[0].body[1]"),
            ("CFG_LOOP_EXIT", "body[0].body[0].orelse[0].body[0]", "body[1]"),
            ("CFG_NEXT", "body[1]", "exit"),
        ]
    )


def test_control_flow_before_a_jump(spark):
    text = "def f(a):\n    a = 1\n    return a\n    b = 2\nbreak\n"
    base = "body[0]"
    assert edges_of(spark, text, "CFG") == sorted(
        [
            ("CFG_NEXT", "entry", "body[0]"),
            ("CFG_NEXT", f"{base}.entry", f"{base}.body[0]"),
            ("CFG_RETURN", f"{base}.body[1]", f"{base}.exit"),
            ("CFG_NEXT", f"{base}.body[2]", f"{base}.exit"),
        ]
    )


def test_data_flow_of_nested_loops(spark):
    text = "x = 0\nwhile a:\n    print(x)\n    for i in x:\n        if i:\n            x = 1\n        else:\n            x = 2\n    x += x\nprint(x)\n"
    found = [(s, t) for _, s, t in edges_of(spark, text, "DFG") if ".target" not in t]
    x0, one, two = "body[0].targets[0]", "body[1].body[1].body[0].body[0].targets[0]", "body[1].body[1].body[0].orelse[0].targets[0]"
    plus = "body[1].body[2].target"
    looked, iterated, doubled = "body[1].body[0].value.args[0]", "body[1].body[1].iter", "body[1].body[2].value"
    after, tested, i = "body[2].value.args[0]", "body[1].body[1].body[0].test", "body[1].body[1].target"
    assert sorted(found) == sorted(
        [(x0, looked), (plus, looked), (x0, iterated), (plus, iterated), (one, iterated), (two, iterated)]
        + [(plus, doubled), (x0, after), (plus, after), (i, tested)]
    )


def test_golden_event_id(spark):
    made = spark.range(1).select(ids.event_id("NODE_UPSERT", "node_1", "hash_abc", "1.0.0", "1.0").alias("i")).first().i
    assert made == "49dd2962c937e062578cc558fadd667a2e0d80de64734105356df8f1034a0338"


def test_merge_keeps_the_first_builder(spark):
    one = spark.createDataFrame([("f", "a", 1)], "file_id string, node_id string, v int")
    two = spark.createDataFrame([("f", "a", 2), ("f", "b", 3), ("g", "a", 4)], "file_id string, node_id string, v int")
    assert sorted(r.v for r in graph.merge(one, two, key="node_id").collect()) == [1, 3, 4]
