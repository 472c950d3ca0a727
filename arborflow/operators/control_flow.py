"""Statement-level control flow of every scope, as one self-join.

Where control goes after a statement is found by walking its enclosing blocks outwards to the first one that
decides: a block with a further statement hands over to that sibling, a loop body hands back to the loop, a
scope body leaves through the scope's exit; the arms of an `if` decide nothing and are passed through. The
chain of blocks travels in each row, so only the sibling needs looking up.

Return, break and continue never are a target; edges into them do not exist (a property of the data model).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.functions import ids
from arborflow.operators.flatten import syntax_rows
from arborflow.operators.syntax_graph import EDGE_COLUMNS, NODE_COLUMNS, edge, own_id, path_above

LOOPS = ("While", "For")
JUMPS = ("Return", "Break", "Continue")
SCOPES = ("Module", "FunctionDef", "AsyncFunctionDef")


def _scope_node(kind: str, levels: Column) -> Column:
    """Id of the entry or exit node of the scope `levels` steps up."""
    path = F.concat(path_above(F.col("ast_path"), levels), F.lit(f".{kind.removeprefix('Scope').lower()}"))
    return ids.node_id(F.col("file_id"), kind, F.col("qualified_scope"), "", path)


def _owner_id(block: Column, levels: Column) -> Column:
    """Id of the if or loop that owns an enclosing block (same scope, no semantic key)."""
    path = path_above(F.col("ast_path"), levels)
    return ids.node_id(F.col("file_id"), block["owner_type"], F.col("qualified_scope"), "", path)


def _first(blocks: Column, test) -> Column:
    """1-based position of the first block that passes, 0 if none."""
    return F.array_position(F.transform(blocks, lambda b: F.coalesce(test(b), F.lit(False))), True).cast("int")


def statements(flat: DataFrame) -> DataFrame:
    """Control-flow statements with their id and direct block."""
    return (
        syntax_rows(flat)
        .where(F.col("blocks").isNotNull())
        .select(
            "file_id",
            "node_type",
            "semantic_key",
            "qualified_scope",
            "ast_path",
            "has_else",
            "blocks",
            own_id().alias("node_id"),
            F.col("node_type").isin(*JUMPS).alias("jumps"),
            F.col("blocks")[0].alias("block"),
        )
    )


def scope_nodes(flat: DataFrame) -> DataFrame:
    """Entry and exit node of every scope with a body, made from the scope's first statement."""
    kinds = F.array(*[F.lit(k) for k in ("ScopeEntry", "ScopeExit")])
    label = F.lower(F.regexp_replace("node_type", "^Scope", ""))
    first = syntax_rows(flat).where(opens_scope())
    nothing = [F.lit(None).cast("int").alias(c) for c in ("line_start", "column_start", "line_end", "column_end")]
    return (
        first.select("file_id", "qualified_scope", F.explode(kinds).alias("node_type"), path_above(F.col("ast_path")).alias("scope_path"))
        .withColumn("name", label)
        .withColumn("ast_path", F.concat_ws(".", "scope_path", "name"))
        .select(
            "file_id",
            ids.node_id(F.col("file_id"), F.col("node_type"), F.col("qualified_scope"), "", F.col("ast_path")).alias("node_id"),
            "node_type",
            "name",
            F.concat_ws(".", "qualified_scope", "name").alias("qualified_name"),
            "ast_path",
            *nothing,
            F.lit("{}").alias("properties"),
        )
        .select(NODE_COLUMNS)
    )


def _followed(stmts: DataFrame) -> DataFrame:
    """Add `follow`: the node control reaches after the statement (after its loop, for break and continue)."""
    loop_at = _first(F.col("blocks"), lambda b: b["owner_type"].isin(*LOOPS))
    leaves_loop = F.col("node_type").isin("Break", "Continue")
    # A break or continue outside any loop goes nowhere.
    placed = stmts.withColumn("skip", F.when(leaves_loop, loop_at).otherwise(0)).where(~leaves_loop | (F.col("skip") > 0))
    routed = placed.withColumn(
        "route", F.slice("blocks", F.col("skip") + 1, F.greatest(F.size("blocks") - F.col("skip"), F.lit(0)))
    ).withColumn("hop", _first(F.col("route"), lambda b: ~b["is_last"] | (b["owner_type"] != "If")))
    decider = F.element_at("route", F.col("hop"))
    levels = F.col("skip") + F.col("hop")
    direct = F.when(decider["owner_type"].isin(*SCOPES), _scope_node("ScopeExit", levels)).otherwise(
        _owner_id(decider, levels)
    )
    asked = routed.withColumn("decider", decider).withColumn("direct", F.when(F.col("decider.is_last"), direct))
    siblings = stmts.select(
        "file_id",
        F.col("block.owner_seq").alias("owner_seq"),
        F.col("block.field").alias("in_field"),
        F.col("block.idx").alias("idx"),
        F.when(~F.col("jumps"), F.col("node_id")).alias("sibling"),
    )
    # No sibling is wanted where the block itself decides, so those rows get a NULL key and stay unmatched.
    wanted = asked.withColumn("owner_seq", F.when(F.col("direct").isNull(), F.col("decider.owner_seq")))
    wanted = wanted.withColumn("in_field", F.col("decider.field")).withColumn("idx", F.col("decider.idx") + 1)
    joined = wanted.join(siblings, ["file_id", "owner_seq", "in_field", "idx"], "left")
    return joined.withColumn("follow", F.coalesce("direct", "sibling"))


def _leaving() -> Column:
    """Type of the edge from a statement to what follows it, NULL where it has none of its own."""
    kind = F.col("node_type")
    return (
        F.when(kind == "If", F.when(~F.col("has_else"), "CFG_FALSE"))
        .when(kind.isin(*LOOPS) | (kind == "Break"), "CFG_LOOP_EXIT")
        .when(kind == "Continue", "CFG_LOOP_BACK")
        .otherwise("CFG_NEXT")
    )


def edge_count() -> Column:
    """How many control-flow edges a flattened row stands for, by the rules of cfg_edges without its join."""
    blocks, kind = F.col("blocks"), F.col("node_type")
    block, jumps = F.get(blocks, 0), kind.isin(*JUMPS)
    leaves_loop = kind.isin("Break", "Continue")
    skip = F.when(leaves_loop, _first(blocks, lambda b: b["owner_type"].isin(*LOOPS))).otherwise(0)
    route = F.slice(blocks, skip + 1, F.greatest(F.size(blocks) - skip, F.lit(0)))
    decider = F.get(F.filter(route, lambda b: ~b["is_last"] | (b["owner_type"] != "If")), 0)
    onward = (kind != "Return") & (~leaves_loop | (skip > 0)) & _leaving().isNotNull() & (decider["is_last"] | ~decider["next_jumps"])
    into = ~jumps & (block["idx"] == 0)
    back = ~jumps & block["owner_type"].isin(*LOOPS) & block["is_last"]
    one = lambda test: F.coalesce(test.cast("int"), F.lit(0))
    return F.when(blocks.isNotNull(), one(onward) + one(into) + one(back) + one(kind == "Return")).otherwise(0)


def opens_scope() -> Column:
    """Whether a flattened row is the first statement of a scope, which has an entry and an exit node."""
    block = F.get("blocks", 0)
    return F.coalesce(block["owner_type"].isin(*SCOPES) & (block["idx"] == 0), F.lit(False))


def cfg_edges(flat: DataFrame) -> DataFrame:
    stmts = statements(flat)
    kind = F.col("node_type")
    leaving = _leaving()
    onward = (
        _followed(stmts.where(kind != "Return"))
        .where(F.col("follow").isNotNull() & leaving.isNotNull())
        .select(*edge(F.col("node_id"), F.col("follow"), leaving))
    )
    # Edges between a statement and the owner of its block.
    owner, block = F.col("block.owner_type"), F.col("block")
    owner_id = _owner_id(block, F.lit(1))
    entered = (
        F.when(owner.isin(*SCOPES), "CFG_NEXT")
        .when(owner.isin(*LOOPS), "CFG_LOOP_BODY")
        .when(F.col("block.field") == "body", "CFG_TRUE")
        .otherwise("CFG_FALSE")
    )
    into = F.when(
        ~F.col("jumps") & (F.col("block.idx") == 0),
        F.struct(
            F.when(owner.isin(*SCOPES), _scope_node("ScopeEntry", F.lit(1))).otherwise(owner_id).alias("source"),
            F.col("node_id").alias("target"),
            entered.alias("kind"),
        ),
    )
    back = F.when(
        ~F.col("jumps") & owner.isin(*LOOPS) & F.col("block.is_last"),
        F.struct(F.col("node_id").alias("source"), owner_id.alias("target"), F.lit("CFG_LOOP_BACK").alias("kind")),
    )
    returned = F.when(
        kind == "Return",
        F.struct(
            F.col("node_id").alias("source"),
            _scope_node("ScopeExit", F.size("blocks")).alias("target"),
            F.lit("CFG_RETURN").alias("kind"),
        ),
    )
    local = (
        stmts.select("file_id", F.explode(F.array_compact(F.array(into, back, returned))).alias("e"))
        .select(*edge(F.col("e.source"), F.col("e.target"), F.col("e.kind")))
    )
    return local.unionByName(onward).select(EDGE_COLUMNS)
