"""Python source -> one row per syntax node.

This is the only step that needs Python's own grammar. It turns each file's syntax tree into flat rows and
leaves the graph work (ids, edges, control flow, call resolution, statistics) to DataFrame operators.
A row carries small facts about its surroundings so that most edges need no join:

* parent_*      what the parent's id is made of (its path is the row's own path without the last step)
* caller_*      on calls: the function, or module, the call sits in, and how deep that one is
* blocks        on statements of a control-flow block: the enclosing blocks up to the scope, nearest first
* reads         on names, parameters and nested definitions: each time data-flow evaluation meets them
* dfg_pairs     on the module, if counts are asked for: how many definition-use pairs the file has

A file costs its own tree in one Python worker. What the grammar rejects becomes the file's error; a worker that
runs out of memory or stack fails its task instead.
"""

import ast
import time
from collections import namedtuple
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from arborflow.operators.reaching import reaching_pairs

FLAT_SCHEMA = """
    file_id string, seq int, depth int, node_type string, ast_path string, qualified_scope string,
    semantic_key string, name string, line_start int, column_start int, line_end int, column_end int,
    value_type string, field string, child_index int, parent_seq int, parent_type string, parent_scope string,
    parent_key string, caller_type string, caller_scope string, caller_key string, caller_depth int,
    call_text string, alias_as string, import_module string, import_level int, has_else boolean,
    blocks array<struct<owner_seq:int, owner_type:string, field:string, idx:int, is_last:boolean, next_jumps:boolean>>,
    scope_seq int, scope_name string,
    reads array<struct<at:int, kind:string, frames:array<struct<seq:int, arm:string>>>>,
    dfg_pairs bigint, parse_ms bigint, error string
"""
_ROWS_PER_BATCH = 20_000

FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)
DEFINITIONS = FUNCTIONS + (ast.ClassDef,)
SCOPES = (*FUNCTIONS, ast.Module)
LOOPS = (ast.While, ast.For)
BRANCHES = (ast.If,) + LOOPS
JUMPS = (ast.Return, ast.Break, ast.Continue)
ABOVE_STATEMENTS = (ast.stmt, ast.excepthandler, ast.match_case, ast.alias)  # expressions hold none of these
STATEMENTS = tuple(c.__name__ for c in ast.stmt.__subclasses__())  # node types that may have `blocks`


_KEY_FIELD = {ast.Name: "id", ast.arg: "arg", ast.Attribute: "attr"} | dict.fromkeys(DEFINITIONS, "name")


_Class = namedtuple("_Class", "kind key labels placed definition scope branch fields")


@cache
def _class(cls):
    """What rows need to know of a node's class."""
    labels = tuple(field for field in ("name", "id", "arg", "attr") if field in cls._fields)
    return _Class(cls.__name__, _KEY_FIELD.get(cls), labels, bool(cls._attributes), cls in DEFINITIONS, cls in SCOPES, cls in BRANCHES, cls._fields)


def _key(node):
    """The part of a node that tells same-typed siblings apart in its id."""
    if type(node) is ast.Constant:
        return type(node.value).__name__
    field = _KEY_FIELD.get(type(node))
    return getattr(node, field) if field else ""


def _label(node):
    """First non-empty name-like field (for a match pattern this may be a node, shown as Python shows it)."""
    text = None
    for field in _class(type(node)).labels:
        text = getattr(node, field, None)
        if text:
            break
    return text if text is None else str(text)


def _spine(target):
    """A dotted expression's nodes from the outermost attribute down to its base."""
    yield target
    while type(target) is ast.Attribute:
        target = target.value
        yield target


def _call_text(node):
    """The called name with its dots, as far as it is made of names; None for a call on a call result."""
    *attributes, base = _spine(node.func)
    start = [base.id] if type(base) is ast.Name else []
    words = start + [step.attr for step in reversed(attributes)]
    return ".".join(words) if words and type(base) is not ast.Call else None


def _opens_block(node, field):
    """Whether control flow looks inside `node.field`."""
    if field == "body" and isinstance(node, SCOPES):
        return True
    return isinstance(node, ast.If) and field in ("body", "orelse") or isinstance(node, LOOPS) and field == "body"


def _evaluated(node):
    """Children in data-flow evaluation order, each with the arm of `node` it belongs to (None: straight on)."""
    if isinstance(node, DEFINITIONS + (ast.Name,)):
        return []
    if isinstance(node, ast.If):
        return [(node.test, None)] + [(s, "then") for s in node.body] + [(s, "else") for s in node.orelse]
    if isinstance(node, LOOPS):
        head = [node.test] if isinstance(node, ast.While) else [node.target, node.iter]
        return [(part, "loop") for part in head + node.body]
    if isinstance(node, ast.Assign):
        parts = [node.value, *node.targets]
    elif isinstance(node, ast.AnnAssign):
        parts = [node.value, node.target]
    elif isinstance(node, ast.AugAssign):
        parts = [node.target, node.value, node.target]
    else:
        parts = list(ast.iter_child_nodes(node))
    return [(part, None) for part in parts if part is not None]


def _scopes(tree):
    """The module and its functions; they stand in lists of statements only."""
    todo = [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, SCOPES):
            yield node
        for field in ("body", "orelse", "finalbody", "handlers", "cases"):
            todo += getattr(node, field, ())


def _reads(scope):
    """(node, position, def or use, arms around it) as data-flow evaluation of one scope meets its nodes.

    Arms are (statement, arm) with the statement still a tree node; its number is known once rows are made.
    """
    at = 0
    for parameter in scope.args.args if isinstance(scope, FUNCTIONS) else []:
        yield parameter, at, "def", ()
        at += 1
    todo = [(statement, ()) for statement in reversed(scope.body)]
    while todo:
        node, frames = todo.pop()
        kind = "def" if isinstance(node, DEFINITIONS) else None
        if type(node) is ast.Name:
            kind = {ast.Store: "def", ast.Load: "use"}.get(type(node.ctx))
        if kind:
            yield node, at, kind, frames
            at += 1
        for part, arm in reversed(_evaluated(node)):
            todo.append((part, (*frames, (id(node), arm)) if arm else frames))


def _pairs(tree) -> int:
    """Number of definition-use pairs in the scopes of a file."""
    total = 0
    for scope in _scopes(tree):
        events = {}
        for node, _, way, frames in _reads(scope):
            events.setdefault(_key(node), []).append((way, str(id(node)), frames))
        total += sum(1 for own in events.values() for _ in reaching_pairs(own))
    return total


_NOTHING = (None,) * 4
_NOT_READ = (None,) * 3
# What a row hands down to the rows below it.
_Above = namedtuple("_Above", "seq type path depth scope key inner caller blocks module level")


def _rows(tree, file_id, parse_ms, counted, types, with_reads):
    """Rows of the given node types (None: all) in pre-order, in the column order of FLAT_SCHEMA."""
    reads = {}
    shallow = types is not None and set(types) <= {*STATEMENTS, "alias"}
    inside = ABOVE_STATEMENTS if shallow else ast.AST
    pairs = _pairs(tree) if counted else None
    numbers = {}  # of scopes, ifs and loops: all come before what is inside them
    seq = -1
    todo = [(tree, None, None, None, None)]
    while todo:
        node, up, field, index, blocks = todo.pop()
        seq += 1
        cls = type(node)
        about = _class(cls)
        kind = about.kind
        if not about.fields and types is not None and kind not in types:
            continue
        key = getattr(node, about.key) if about.key else type(node.value).__name__ if cls is ast.Constant else ""
        if up is None:
            path, depth, scope, caller = "Module", 0, "Module", None
        else:
            path = f"{up.path}.{field}" if index is None else f"{up.path}.{field}[{index}]"
            depth, scope, caller = up.depth + 1, up.inner, up.caller
        inner = f"{scope}.{node.name}" if about.definition else scope
        if about.scope:
            caller = (kind, scope, key, depth)
            if with_reads:
                for name, at, way, frames in _reads(node):
                    reads.setdefault(id(name), (seq, inner, []))[2].append((at, way, frames))
        if about.scope or about.branch:
            numbers[id(node)] = seq
        if types is None or kind in types:
            scope_seq, scope_name, met = reads.get(id(node), _NOT_READ)
            if met:
                met = [(at, way, [(numbers[s], arm) for s, arm in frames]) for at, way, frames in met]
            is_call = cls is ast.Call
            yield (
                file_id, seq, depth, kind, path, scope, key, _label(node) if up else "Module",
                *((node.lineno, node.col_offset, node.end_lineno, node.end_col_offset) if about.placed else _NOTHING),
                key if cls is ast.Constant else None,
                field, None if up is None else index or 0, *((up.seq, up.type, up.scope, up.key) if up else _NOTHING),
                *(caller if is_call else _NOTHING), _call_text(node) if is_call else None,
                *((node.asname, up.module, up.level) if cls is ast.alias else (None, None, None)),
                bool(node.orelse) if cls is ast.If else None,
                blocks, scope_seq, scope_name, met,
                pairs if up is None else None, parse_ms if up is None else None, None,
            )
        if about.fields:
            above = _Above(
                seq, kind, path, depth, scope, key, inner, caller, blocks or [],
                getattr(node, "module", None), getattr(node, "level", None),
            )
            active = blocks is not None or about.scope
            below = []
            for child_field in about.fields:
                value = getattr(node, child_field, None)
                if isinstance(value, inside):
                    below.append((value, above, child_field, None, None))
                elif isinstance(value, list):
                    opens = active and _opens_block(node, child_field)
                    for child_index, child in enumerate(value):
                        if isinstance(child, inside):
                            chain = None
                            if opens:
                                last = child_index == len(value) - 1
                                jumps = not last and isinstance(value[child_index + 1], JUMPS)
                                chain = [(seq, kind, child_field, child_index, last, jumps)] + (above.blocks if about.branch else [])
                            below.append((child, above, child_field, child_index, chain))
            below.reverse()
            todo += below


def _parsed(file_id, file_path, content, width, counted, types=None, with_reads=True):
    """Rows of one file; a file that does not parse gives one row with seq -1 and its error."""
    started = time.perf_counter()
    if content is None:
        return [(file_id, -1, *(None,) * (width - 3), f"ReadFileError in {file_path}: gone or changed since it was listed")]
    try:
        tree = ast.parse(bytes(content).decode("utf-8", errors="replace"), filename=file_path)
    except SyntaxError as bad:
        message = f"SyntaxError in {file_path}: {bad.msg} at line {bad.lineno}, col {bad.offset}"
    except ValueError as bad:  # null bytes
        message = f"ValueError in {file_path}: {bad}"
    else:
        return _rows(tree, file_id, int((time.perf_counter() - started) * 1000), counted, types, with_reads)
    return [(file_id, -1, *(None,) * (width - 3), message)]


def flatten(sources: DataFrame, counted=False, columns=None, types=None) -> DataFrame:
    """`sources` needs file_id, file_path and content; texts stay in the splits they come in.

    With `counted`, the module's row has the number of data-flow pairs, for statistics without building edges. A
    consumer that needs only some columns, or rows of some node types, names them: Spark cannot see through the Python
    step, and what is not named is not made there. Files that do not parse have their row in any case. Of statements
    and imported names alone, expressions are not opened: `seq` then has the same order, but smaller numbers.
    """
    fields = StructType.fromDDL(FLAT_SCHEMA)
    wanted = StructType([f for f in fields if columns is None or f.name in columns])
    places = [place for place, f in enumerate(fields) if f in wanted.fields]
    arrow = to_arrow_schema(wanted)
    width, with_reads = len(fields), bool({"reads", "scope_seq", "scope_name"} & set(wanted.names))

    def batch_of(rows):
        whole = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(whole[place], f.type) for place, f in zip(places, arrow)], schema=arrow)

    def parsing(batches):
        held = []
        for batch in batches:
            for at in range(batch.num_rows):
                file_id, file_path, content = [column[at].as_py() for column in batch.columns]
                for row in _parsed(file_id, file_path, content, width, counted, types, with_reads):
                    held.append(row)
                    if len(held) == _ROWS_PER_BATCH:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    inputs = sources.select("file_id", "file_path", F.col("content").cast("binary").alias("content"))
    return inputs.mapInArrow(parsing, wanted)


def syntax_rows(flat: DataFrame) -> DataFrame:
    return flat.where("seq >= 0")


def parse_errors(flat: DataFrame) -> DataFrame:
    return flat.where("seq < 0").select("file_id", F.col("error").alias("message"))
