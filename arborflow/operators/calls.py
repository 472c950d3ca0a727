"""Call graph: imports, module-level symbols and call sites joined by name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.functions import ids
from arborflow.operators.flatten import DEFINITIONS, syntax_rows
from arborflow.operators.syntax_graph import EDGE_COLUMNS, NODE_COLUMNS, edge, own_id

_DEFINITION_TYPES = [t.__name__ for t in DEFINITIONS]


def imports(flat: DataFrame) -> DataFrame:
    """Local alias -> (qualified name, resolution); the last one in breadth-first order wins."""
    known = F.coalesce("import_module", F.lit(""))
    target = F.struct(
        F.when(known != "", F.concat_ws(".", known, "name")).otherwise(F.col("name")).alias("qualified"),
        F.when(F.col("import_level") > 0, "IMPORTED_MODULE_ATTRIBUTE").otherwise("IMPORTED_SYMBOL").alias("resolution"),
    )
    local = F.when(F.col("alias_as") != "", F.col("alias_as")).otherwise(F.col("name"))
    return (
        syntax_rows(flat)
        .where((F.col("node_type") == "alias") & F.col("parent_type").isin("Import", "ImportFrom"))
        .select("file_id", local.alias("symbol"), target.alias("target"), "depth", "seq")
        .groupBy("file_id", "symbol")
        .agg(F.max_by("target", F.struct("depth", "seq")).alias("target"))
        .select("file_id", "symbol", "target.qualified", "target.resolution")
    )


def local_symbols(flat: DataFrame) -> DataFrame:
    """Functions and classes defined directly in the module; a redefinition wins."""
    return (
        syntax_rows(flat)
        .where((F.col("depth") == 1) & F.col("node_type").isin(*_DEFINITION_TYPES))
        .select("file_id", F.col("semantic_key").alias("symbol"), "seq", own_id().alias("node_id"))
        .groupBy("file_id", "symbol")
        .agg(F.max_by("node_id", "seq").alias("local_id"))
    )


def call_sites(flat: DataFrame) -> DataFrame:
    caller_path = F.array_join(F.slice(F.split("ast_path", r"\."), F.lit(1), F.col("caller_depth") + 1), ".")
    caller = ids.node_id(F.col("file_id"), F.col("caller_type"), F.col("caller_scope"), F.col("caller_key"), caller_path)
    return (
        syntax_rows(flat)
        .where((F.col("node_type") == "Call") & (F.col("call_text") != ""))
        .select("file_id", "seq", "call_text", own_id().alias("call_site_id"), caller.alias("caller_id"))
    )


def resolve_calls(flat: DataFrame) -> DataFrame:
    """Every call site with its target: local symbol, then imported text, then import of the first dotted part.

    The three lookups share two equi-joins on (file_id, symbol): locals and imports are one table of names.
    """
    names = local_symbols(flat).join(imports(flat), ["file_id", "symbol"], "full")
    whole = names.select(
        "file_id", F.col("symbol").alias("call_text"), "local_id", F.col("qualified").alias("exact"), "resolution"
    )
    heads = names.where(F.col("qualified").isNotNull()).select(
        "file_id", F.col("symbol").alias("head"), F.col("qualified").alias("head_qualified")
    )
    dotted = F.col("call_text").contains(".")
    sites = call_sites(flat).withColumn("head", F.when(dotted, F.substring_index("call_text", ".", 1)))
    joined = sites.join(whole, ["file_id", "call_text"], "left").join(heads, ["file_id", "head"], "left")
    rest = F.expr("substring(call_text, length(head) + 2)")
    through_head = F.col("head_qualified").isNotNull()
    qualified = (
        F.when(F.col("local_id").isNotNull(), F.col("call_text"))
        .when(F.col("exact").isNotNull(), F.col("exact"))
        .when(through_head, F.concat_ws(".", "head_qualified", rest))
        .otherwise(F.col("call_text"))
    )
    resolution = (
        F.when(F.col("local_id").isNotNull(), "LOCAL_FUNCTION")
        .when(F.col("exact").isNotNull(), F.col("resolution"))
        .when(through_head, "IMPORTED_MODULE_ATTRIBUTE")
        .otherwise("UNRESOLVED_DYNAMIC_CALL")
    )
    resolved = joined.select(
        "file_id",
        "seq",
        "call_text",
        "call_site_id",
        "caller_id",
        "local_id",
        qualified.alias("qualified_name"),
        resolution.alias("resolution_type"),
    ).withColumn("external_path", F.concat(F.lit("External."), "qualified_name"))
    external = ids.node_id(
        F.col("file_id"), "ExternalSymbol", "External", F.col("qualified_name"), F.col("external_path")
    )
    return resolved.withColumn("target_id", F.coalesce("local_id", external))


def external_symbols(calls: DataFrame) -> DataFrame:
    """One node per file and outside name; the first call gives the short name and the resolution."""
    first = F.struct(
        F.substring_index("call_text", ".", -1).alias("name"),
        F.to_json(F.struct("resolution_type")).alias("properties"),
        F.col("qualified_name"),
        F.col("external_path").alias("ast_path"),
    )
    nothing = [F.lit(None).cast("int").alias(c) for c in ("line_start", "column_start", "line_end", "column_end")]
    return (
        calls.where(F.col("local_id").isNull())
        .groupBy("file_id", F.col("target_id").alias("node_id"))
        .agg(F.min_by(first, "seq").alias("first"))
        .select("file_id", "node_id", F.lit("ExternalSymbol").alias("node_type"), "first.*", *nothing)
        .select(NODE_COLUMNS)
    )


def call_edges(calls: DataFrame) -> DataFrame:
    role = F.concat(F.lit("call|"), F.col("call_site_id"))
    told = F.to_json(
        F.struct(F.col("call_site_id").alias("call_site_node_id"), F.col("call_text"), F.col("resolution_type"))
    )
    return calls.select(*edge(F.col("caller_id"), F.col("target_id"), "CALLS", role, told)).select(EDGE_COLUMNS)
