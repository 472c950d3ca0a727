"""SQL for the graph queries: the syntax tree of each templated statement, placed by line number."""

# Syntax nodes of the statement templates, as `path | type | key | name` per kind of line.
# `=` as name repeats the key; a kind's own statement has the empty path; `h` is the file's header.
NODES = """
0 | | Assign
0 | .targets[0] | Name | note | =
0 | .targets[0].ctx | Store
0 | .value | Call
0 | .value.func | Name | part | =
0 | .value.func.ctx | Load
0 | .value.args[0] | Constant | str
1 | | If
1 | .test | Name | size | =
1 | .test.ctx | Load
1 | .body[0] | Assign
1 | .body[0].targets[0] | Name | size | =
1 | .body[0].targets[0].ctx | Store
1 | .body[0].value | Constant | str
1 | .orelse[0] | Assign
1 | .orelse[0].targets[0] | Name | size | =
1 | .orelse[0].targets[0].ctx | Store
1 | .orelse[0].value | Constant | NoneType
2 | | For
2 | .target | Name | piece | =
2 | .target.ctx | Store
2 | .iter | Name | size | =
2 | .iter.ctx | Load
2 | .body[0] | If
2 | .body[0].test | Name | piece | =
2 | .body[0].test.ctx | Load
2 | .body[0].body[0] | Continue
2 | .body[1] | Assign
2 | .body[1].targets[0] | Name | total | =
2 | .body[1].targets[0].ctx | Store
2 | .body[1].value | Constant | str
3 | | Assign
3 | .targets[0] | Name | total | =
3 | .targets[0].ctx | Store
3 | .value | Call
3 | .value.func | Attribute | clean | =
3 | .value.func.value | Name | tool | =
3 | .value.func.value.ctx | Load
3 | .value.func.ctx | Load
3 | .value.args[0] | Name | total | =
3 | .value.args[0].ctx | Load
3 | .value.args[1] | Constant | str
4 | | FunctionDef | part | =
4 | .args | arguments
4 | .args.args[0] | arg | text | =
4 | .args.args[1] | arg | width | =
4 | .body[0] | While
4 | .body[0].test | Name | text | =
4 | .body[0].test.ctx | Load
4 | .body[0].body[0] | Assign
4 | .body[0].body[0].targets[0] | Name | text | =
4 | .body[0].body[0].targets[0].ctx | Store
4 | .body[0].body[0].value | Name | width | =
4 | .body[0].body[0].value.ctx | Load
4 | .body[0].body[1] | Break
4 | .body[1] | Assign
4 | .body[1].targets[0] | Name | width | =
4 | .body[1].targets[0].ctx | Store
4 | .body[1].value | Constant | str
4 | .body[2] | Return
4 | .body[2].value | Call
4 | .body[2].value.func | Attribute | make | =
4 | .body[2].value.func.value | Name | base | =
4 | .body[2].value.func.value.ctx | Load
4 | .body[2].value.func.ctx | Load
4 | .body[2].value.args[0] | Name | text | =
4 | .body[2].value.args[0].ctx | Load
4 | .entry | ScopeEntry | | entry
4 | .exit | ScopeExit | | exit
h | | Module | | Module
h | .body[0] | Import
h | .body[0].names[0] | alias | | json
h | .body[1] | ImportFrom
h | .body[1].names[0] | alias | | base
h | .body[2] | Assign
h | .body[2].targets[0] | Name | size | =
h | .body[2].targets[0].ctx | Store
h | .body[2].value | Constant | int
h | .body[3] | Assign
h | .body[3].targets[0] | Name | total | =
h | .body[3].targets[0].ctx | Store
h | .body[3].value | Name | size | =
h | .body[3].value.ctx | Load
h | .entry | ScopeEntry | | entry
h | .exit | ScopeExit | | exit
"""
# Control flow inside one line's statement; `>` is whatever comes after it.
FLOW = """
0 | CFG_NEXT | | >
1 | CFG_TRUE | | .body[0]
1 | CFG_FALSE | | .orelse[0]
1 | CFG_NEXT | .body[0] | >
1 | CFG_NEXT | .orelse[0] | >
2 | CFG_LOOP_BODY | | .body[0]
2 | CFG_LOOP_EXIT | | >
2 | CFG_FALSE | .body[0] | .body[1]
2 | CFG_LOOP_BACK | .body[0].body[0] | >
2 | CFG_NEXT | .body[1] |
2 | CFG_LOOP_BACK | .body[1] |
3 | CFG_NEXT | | >
4 | CFG_NEXT | | >
4 | CFG_NEXT | .entry | .body[0]
4 | CFG_LOOP_BODY | .body[0] | .body[0].body[0]
4 | CFG_LOOP_EXIT | .body[0].body[1] | .body[1]
4 | CFG_LOOP_EXIT | .body[0] | .body[1]
4 | CFG_RETURN | .body[2] | .exit
h | CFG_NEXT | .entry | .body[0]
h | CFG_NEXT | .body[0] | .body[1]
h | CFG_NEXT | .body[1] | .body[2]
h | CFG_NEXT | .body[2] | .body[3]
h | CFG_NEXT | .body[3] | >
"""
# Definitions that reach a use of the same line: kind | variable | definition | use.
REACH = """
2 | piece | .target | .body[0].test
4 | text | .args.args[0] | .body[0].test
4 | text | .body[0].body[0].targets[0] | .body[0].test
4 | width | .args.args[1] | .body[0].body[0].value
4 | text | .args.args[0] | .body[2].value.args[0]
4 | text | .body[0].body[0].targets[0] | .body[2].value.args[0]
h | size | .body[2].targets[0] | .body[3].value
"""


def _values(text, width):
    rows = [[cell.strip() for cell in line.split("|")] for line in text.strip().splitlines()]
    rows = [row + [""] * (width - len(row)) for row in rows]
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{c}'" for c in row) + ")" for row in rows) + ")"


# One row per document, and one per line of it; header statements are 0 to 3, line i is 4 + i.
_BASE = f"""
docs AS MATERIALIZED (SELECT doc_id, sha256('docs|' || source || '/' || doc_id || '.py') AS fid, source || '/' || doc_id || '.py' AS file_path,
         string_split(text, chr(10)) AS ls, text, n_chars FROM documents),
l AS MATERIALIZED (SELECT fid, file_path, i, CAST(length(ls[i]) % 5 AS VARCHAR) AS kind, 'Module.body[' || (i + 3) || ']' AS stem, len(ls) AS n
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
placed AS MATERIALIZED (SELECT fid, kind, i, stem, n FROM l UNION ALL SELECT fid, 'h', 0, 'Module', len(ls) FROM docs),
t AS (SELECT * FROM {_values(NODES, 5)} x(kind, rel, type, key, name)),
p AS (SELECT fid, kind, i, rel, type, key, stem || rel AS ast_path,
        CASE WHEN name = '=' THEN key WHEN name <> '' THEN name END AS name,
        CASE WHEN kind = '4' AND rel <> '' THEN 'Module.part' ELSE 'Module' END AS scope FROM placed JOIN t USING (kind)),
nodes AS MATERIALIZED (SELECT *, sha256(fid || '|' || type || '|' || scope || '|' || key || '|' || ast_path) AS id FROM p)"""
_CALLS = """
parts AS (SELECT fid, max(i) AS last_part FROM l WHERE kind = '4' GROUP BY fid),
c AS (SELECT n.fid, n.kind, n.i, n.id AS site, n.rel FROM nodes n WHERE type = 'Call'),
q AS (SELECT c.*, last_part, CASE WHEN kind = '3' THEN 'json.clean' WHEN kind = '4' THEN 'base.make' ELSE 'part' END AS qn,
        CASE WHEN kind IN ('3', '4') THEN 'IMPORTED_MODULE_ATTRIBUTE' WHEN last_part IS NOT NULL THEN 'LOCAL_FUNCTION'
             ELSE 'UNRESOLVED_DYNAMIC_CALL' END AS res FROM c LEFT JOIN parts USING (fid)),
x AS (SELECT *, sha256(fid || '|ExternalSymbol|External|' || qn || '|External.' || qn) AS ext FROM q)"""
_CFG = f"""
f AS (SELECT * FROM {_values(FLOW, 4)} y(kind, type, src, dst)),
cfg AS (SELECT a.id AS source_id, b.id AS target_id, f.type AS edge_type, a.fid FROM nodes a JOIN f ON f.kind = a.kind AND f.src = a.rel
        JOIN placed o ON o.fid = a.fid AND o.i = a.i
        JOIN nodes b ON b.fid = a.fid AND b.ast_path = CASE WHEN dst <> '>' THEN o.stem || dst WHEN a.i < n THEN 'Module.body[' || (a.i + 4) || ']' ELSE 'Module.exit' END)"""
# Across lines: the newest replacing definition before the use, and for `total` the loop definitions since.
_DFG = f"""
s AS (SELECT * FROM {_values(REACH, 4)} y(kind, variable, src, dst)),
u AS (SELECT fid, kind, i, id, rel, CASE rel WHEN '.value.args[0]' THEN 'total' WHEN '.value.func' THEN 'part' ELSE 'size' END AS variable
      FROM nodes WHERE kind || rel IN ('1.test', '2.iter', '3.value.args[0]', '0.value.func')),
b AS (SELECT u.fid, u.i, u.id, u.variable, max(l.i) FILTER (l.kind = CASE u.variable WHEN 'size' THEN '1' WHEN 'total' THEN '3' ELSE '4' END) AS replaced
      FROM u LEFT JOIN l ON l.fid = u.fid AND l.i < u.i GROUP BY 1, 2, 3, 4),
across AS (
  SELECT b.fid, d.id AS source_id, b.id AS target_id, variable FROM b JOIN nodes d ON d.fid = b.fid AND d.i = coalesce(replaced, 0)
   AND d.kind || d.rel IN (CASE variable WHEN 'size' THEN '1.body[0].targets[0]' WHEN 'total' THEN '3.targets[0]' ELSE '4' END,
                           CASE variable WHEN 'size' THEN '1.orelse[0].targets[0]' END,
                           CASE variable WHEN 'size' THEN 'h.body[2].targets[0]' WHEN 'total' THEN 'h.body[3].targets[0]' END)
  UNION ALL
  SELECT b.fid, d.id, b.id, variable FROM b JOIN nodes d ON d.fid = b.fid AND variable = 'total' AND d.kind = '2'
   AND d.rel = '.body[1].targets[0]' AND d.i < b.i AND d.i > coalesce(replaced, 0)),
dfg AS (SELECT fid, source_id, target_id, variable, 'Module' AS scope FROM across
  UNION ALL SELECT a.fid, a.id, c.id, variable, CASE WHEN a.kind = '4' THEN 'Module.part' ELSE 'Module' END
  FROM s JOIN nodes a ON a.kind = s.kind AND a.rel = s.src JOIN nodes c ON c.fid = a.fid AND c.i = a.i AND c.kind = a.kind AND c.rel = s.dst)"""
_CALLED = """
called AS (SELECT x.fid, m.id AS source_id, CASE WHEN res = 'LOCAL_FUNCTION' THEN d.id ELSE ext END AS target_id, res, site FROM x
  JOIN nodes m ON m.fid = x.fid AND m.rel = '' AND m.kind = CASE WHEN x.kind = '4' THEN '4' ELSE 'h' END AND m.i = CASE WHEN x.kind = '4' THEN x.i ELSE 0 END
  LEFT JOIN nodes d ON d.fid = x.fid AND d.kind = '4' AND d.rel = '' AND d.i = last_part)"""
_COUNTS = """
ast_n AS (SELECT fid, count(*) AS n, count(*) FILTER (type NOT LIKE 'Scope%') - 1 AS e FROM nodes GROUP BY fid),
ext_n AS (SELECT fid, count(DISTINCT ext) AS n FROM x WHERE res <> 'LOCAL_FUNCTION' GROUP BY fid),
edge_n AS (SELECT fid, sum(c) AS e FROM (SELECT fid, count(*) AS c FROM cfg GROUP BY fid UNION ALL SELECT fid, count(*) FROM dfg GROUP BY fid
   UNION ALL SELECT fid, count(*) FROM called GROUP BY fid) GROUP BY fid),
kinds AS (SELECT fid, file_path, count(*) AS n, count(*) FILTER (kind = '4') AS defs,
   sum(CASE kind WHEN '1' THEN 4 WHEN '2' THEN 4 WHEN '4' THEN 6 ELSE 1 END) AS code_lines FROM l GROUP BY fid, file_path)"""


def graph_statements() -> dict[str, str]:
    def edge(kind, role="''"):
        return f"sha256(source_id || '|' || {kind} || '|' || target_id || '|' || {role}) AS edge_id, source_id, target_id"

    parent = "regexp_replace(ast_path, '[.][^.]*$', '')"
    step = "regexp_extract(ast_path, '[^.]*$')"
    field, index = f"split_part({step}, '[', 1)", f"coalesce(nullif(regexp_extract({step}, '[0-9]+'), ''), '0')"
    children = f"""child AS MATERIALIZED (SELECT c.id AS target_id, p.id AS source_id, {field.replace('ast_path', 'c.ast_path')} AS f, {index.replace('ast_path', 'c.ast_path')} AS ix
        FROM nodes c JOIN nodes p ON p.fid = c.fid AND p.ast_path = {parent.replace('ast_path', 'c.ast_path')} AND c.ast_path <> 'Module' AND c.type NOT LIKE 'Scope%')"""
    return {
        "ast_nodes": f"""WITH {_BASE} SELECT id AS node_id, type AS node_type, name, CASE WHEN type = 'Module' THEN 'Module' WHEN type LIKE 'Scope%' AND kind = '4' THEN 'Module.part.' || name WHEN name IS NOT NULL THEN scope || '.' || name END AS qualified_name, ast_path,
            CASE WHEN type = 'Constant' THEN '{{"value_type":"' || key || '","has_value":' || CASE WHEN key = 'NoneType' THEN 'false' ELSE 'true' END || '}}' ELSE '{{}}' END AS properties FROM nodes""",
        "ast_child_edges": f"""WITH {_BASE}, {children} SELECT {edge("'AST_CHILD'", "f || '|' || ix")}, '{{"field":"' || f || '","child_index":' || ix || '}}' AS properties FROM child""",
        "cfg_edges": f"WITH {_BASE}, {_CFG} SELECT {edge('edge_type')}, edge_type FROM cfg",
        "dfg_edges": f"""WITH {_BASE}, {_DFG} SELECT {edge("'DFG_DEF_USE'", "'dfg|' || variable")}, '{{"variable":"' || variable || '","scope":"' || scope || '","resolution":"REACHING_DEFINITION"}}' AS properties FROM dfg""",
        "call_edges": f"""WITH {_BASE}, {_CALLS}, {_CALLED} SELECT {edge("'CALLS'", "'call|' || site")}, res AS resolution_type FROM called""",
        "external_symbols": f"""WITH {_BASE}, {_CALLS} SELECT DISTINCT ext AS node_id, split_part(qn, '.', -1) AS name, qn AS qualified_name, 'External.' || qn AS ast_path, '{{"resolution_type":"' || res || '"}}' AS properties FROM x WHERE res <> 'LOCAL_FUNCTION'""",
        "import_table": f"WITH {_BASE} SELECT file_path, 'tool' AS symbol, 'json' AS qualified, 'IMPORTED_SYMBOL' AS resolution FROM docs UNION ALL SELECT file_path, 'base', 'base', 'IMPORTED_MODULE_ATTRIBUTE' FROM docs",
        "local_symbols": f"WITH {_BASE}, {_CALLS} SELECT file_path, 'part' AS symbol, id AS local_id FROM parts JOIN nodes USING (fid) JOIN docs USING (fid) WHERE kind = '4' AND rel = '' AND i = last_part",
        "parse_errors": "SELECT source || '/' || doc_id || '.py' AS file_path, 'SyntaxError' AS error FROM documents WHERE lang = 'es'",
        "file_stats": f"""WITH {_BASE}, {_CALLS}, {_CFG}, {_DFG}, {_CALLED}, {_COUNTS} SELECT k.file_path, octet_length(encode(src)) AS size_bytes,
            CAST(4 + code_lines + len(string_split_regex(d.text, '[\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')) - 1 AS BIGINT) AS line_count,
            defs AS function_count, CAST(0 AS BIGINT) AS class_count, CAST(2 AS BIGINT) AS import_count, CAST(a.n + coalesce(x2.n, 0) AS BIGINT) AS node_count,
            CAST(a.e + g.e AS BIGINT) AS edge_count, 'SUCCESS' AS parse_status, 'python.ast' AS parser
          FROM kinds k JOIN docs d USING (fid) JOIN ast_n a USING (fid) LEFT JOIN ext_n x2 USING (fid) JOIN edge_n g USING (fid)
          JOIN (SELECT fid, 'import json as tool' || chr(10) || 'from . import base' || chr(10) || 'size = ' || n_chars || chr(10) || 'total = size' || chr(10)
                 || list_aggregate(list_transform(ls, lambda s: CASE length(s) % 5 WHEN 0 THEN 'note = part("' || {_lit('s')} || '")'
                    WHEN 1 THEN 'if size:' || chr(10) || '    size = "' || {_lit('s')} || '"' || chr(10) || 'else:' || chr(10) || '    size = None'
                    WHEN 2 THEN 'for piece in size:' || chr(10) || '    if piece:' || chr(10) || '        continue' || chr(10) || '    total = "' || {_lit('s')} || '"'
                    WHEN 3 THEN 'total = tool.clean(total, "' || {_lit('s')} || '")'
                    ELSE 'def part(text, width):' || chr(10) || '    while text:' || chr(10) || '        text = width' || chr(10) || '        break' || chr(10)
                      || '    width = "' || {_lit('s')} || '"' || chr(10) || '    return base.make(text)' END), 'string_agg', chr(10)) || chr(10) AS src FROM docs) USING (fid)""",
        "edge_counts": f"WITH {_BASE}, {_CALLS}, {_CFG}, {_DFG}, {_CALLED}, {children} SELECT edge_type, count(*) AS edges FROM (SELECT edge_type FROM cfg UNION ALL SELECT 'DFG_DEF_USE' FROM dfg UNION ALL SELECT 'CALLS' FROM called UNION ALL SELECT 'AST_CHILD' FROM child) GROUP BY edge_type",
    }


def _lit(name):
    """A line as it stands in a Python string literal."""
    return f"replace(replace(replace({name}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(13), chr(92) || 'r')"
