"""Syntax nodes and parent-child edges: projections of the flattened rows, no join and no shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.functions import ids
from arborflow.operators.flatten import syntax_rows

NODE_COLUMNS = [
    "file_id",
    "node_id",
    "node_type",
    "name",
    "qualified_name",
    "ast_path",
    "line_start",
    "column_start",
    "line_end",
    "column_end",
    "properties",
]
EDGE_COLUMNS = ["file_id", "edge_id", "source_id", "target_id", "edge_type", "properties"]


def path_above(path: Column, levels=1) -> Column:
    """The path `levels` steps up."""
    dots = F.length(path) - F.length(F.replace(path, F.lit("."), F.lit("")))
    return F.call_function("substring_index", path, F.lit("."), (dots + 1 - levels).cast("int"))


def own_id() -> Column:
    return ids.node_id(*[F.col(c) for c in ("file_id", "node_type", "qualified_scope", "semantic_key", "ast_path")])


def parent_id() -> Column:
    parts = [F.col(c) for c in ("file_id", "parent_type", "parent_scope", "parent_key")]
    return ids.node_id(*parts, path_above(F.col("ast_path")))


def edge(source: Column, target: Column, edge_type, role="", properties=None) -> list[Column]:
    """The EDGE_COLUMNS of one edge."""
    kind = edge_type if isinstance(edge_type, Column) else F.lit(edge_type)
    return [
        F.col("file_id"),
        ids.edge_id(source, kind, target, role).alias("edge_id"),
        source.alias("source_id"),
        target.alias("target_id"),
        kind.alias("edge_type"),
        (F.lit("{}") if properties is None else properties).alias("properties"),
    ]


def ast_nodes(flat: DataFrame) -> DataFrame:
    qualified = F.when(F.col("node_type") == "Module", "Module").when(
        F.col("name") != "", F.concat_ws(".", "qualified_scope", "name")
    )
    constant = F.to_json(
        F.struct(F.col("value_type"), (F.col("value_type") != "NoneType").alias("has_value")),
    )
    return (
        syntax_rows(flat)
        .withColumn("node_id", own_id())
        .withColumn("qualified_name", qualified)
        .withColumn("properties", F.when(F.col("value_type").isNotNull(), constant).otherwise("{}"))
        .select(NODE_COLUMNS)
    )


def ast_edges(flat: DataFrame) -> DataFrame:
    """One AST_CHILD edge per row but the module's."""
    role = F.concat_ws("|", F.col("field"), F.col("child_index").cast("string"))
    placed = F.to_json(F.struct("field", "child_index"))
    return (
        syntax_rows(flat)
        .where(F.col("parent_seq").isNotNull())
        .select("file_id", "field", "child_index", own_id().alias("child"), parent_id().alias("parent"))
        .select(*edge(F.col("parent"), F.col("child"), "AST_CHILD", role, placed))
    )
