"""Flattened rows narrowed to columns and node types are those of the whole rows."""

import ast

from arborflow.operators import calls, control_flow
from arborflow.operators.flatten import STATEMENTS, _scopes, flatten, parse_errors, syntax_rows
from arborflow.plans import queries

SOURCE = """import a.b as c
from . import d
async def f(x, y=1):
    for i in x:
        try:
            if i: continue
            def g(): return y
        except E as e:
            y = e
        else:
            class K:
                def m(self): return self
    match x:
        case [z]:
            def h(): pass
    return f(c.d(y), d)
"""


def sources(spark):
    rows = [("1", "a.py", SOURCE.encode()), ("2", "b.py", b"f("), ("3", "c.py", b""), ("4", "d.py", None)]
    return spark.createDataFrame(rows, "file_id string, file_path string, content binary").coalesce(1)


def test_narrow_rows(spark):
    whole = flatten(sources(spark)).persist()
    for columns, types in ((queries.PARENT, None), (queries.DATA, ("Name", "arg", *queries.DEFINED)), ([c for c in queries.IMPORTS if c != "seq"] + ["error"], ("alias",)), ((*queries.CALLS, "error"), ("alias", "Call", *queries.DEFINED))):
        narrow = flatten(sources(spark), columns=columns, types=types)
        assert set(narrow.columns) == set(columns)
        want = whole.where(whole.node_type.isin(*types) | (whole.seq < 0)) if types else whole
        assert sorted(map(str, narrow.select(*dict.fromkeys(columns)).collect())) == sorted(map(str, want.select(*dict.fromkeys(columns)).collect()))
    assert parse_errors(flatten(sources(spark), columns=("file_id", "seq", "error"), types=())).count() == 2
    calls_of = [calls.local_symbols(flatten(sources(spark), columns=queries.SYMBOLS, types=queries.DEFINED)), calls.local_symbols(whole)]
    assert calls_of[0].collect() and sorted(map(str, calls_of[0].collect())) == sorted(map(str, calls_of[1].collect()))
    edges = control_flow.cfg_edges(flatten(sources(spark), columns=queries.CONTROL, types=STATEMENTS))
    assert sorted(map(str, edges.collect())) == sorted(map(str, control_flow.cfg_edges(whole).collect()))
    counted = syntax_rows(flatten(sources(spark), counted=True, columns=("file_id", "seq", "dfg_pairs"))).where("seq = 0").orderBy("file_id").collect()
    assert [r.dfg_pairs for r in counted] == [6, 0]


def test_scopes_are_all_functions_and_the_module():
    tree = ast.parse(SOURCE)
    assert sorted(map(id, _scopes(tree))) == sorted(id(n) for n in ast.walk(tree) if isinstance(n, (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef)))
