"""One file set's whole graph: nodes, edges, statistics and parse errors from the flattened rows."""

from collections import namedtuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.constants import PARSER_NAME
from arborflow.functions.text import line_count
from arborflow.operators import calls, control_flow, data_flow, syntax_graph
from arborflow.operators.flatten import flatten, parse_errors, syntax_rows

Graph = namedtuple("Graph", "nodes edges metadata errors")


def first_wins(rows: DataFrame, key: str, order) -> DataFrame:
    """Keep the first row of each key within its file."""
    place = F.row_number().over(Window.partitionBy("file_id", key).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def merge(*parts: DataFrame, key: str) -> DataFrame:
    """Union of the builders' rows, an id of an earlier builder winning over a later one."""
    ranked = [part.withColumn("_builder", F.lit(rank)) for rank, part in enumerate(parts)]
    whole = ranked[0]
    for part in ranked[1:]:
        whole = whole.unionByName(part)
    return first_wins(whole, key, ["_builder"]).drop("_builder")


def graph_nodes(flat: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Syntax, scope and external nodes.

    A node id hashes type, scope, key and path, and no two rows of a file share a path, so the three builders
    cannot collide and external_symbols has one row per id: the union needs no dedup shuffle. `merge` is for
    inputs without that guarantee.
    """
    resolved = calls.resolve_calls(flat) if resolved is None else resolved
    return (
        syntax_graph.ast_nodes(flat)
        .unionByName(control_flow.scope_nodes(flat))
        .unionByName(calls.external_symbols(resolved))
    )


def graph_edges(flat: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """The four kinds of edge; each builder emits an edge once and their types differ, so no dedup shuffle."""
    resolved = calls.resolve_calls(flat) if resolved is None else resolved
    return (
        syntax_graph.ast_edges(flat)
        .unionByName(control_flow.cfg_edges(flat))
        .unionByName(data_flow.dfg_edges(flat))
        .unionByName(calls.call_edges(resolved))
    )


def syntax_counts(flat: DataFrame) -> DataFrame:
    """Functions, classes, imported names, nodes and edges (without external symbols) and parse time per file.

    One aggregate with map-side combine over `flat`, which was flattened with counts: no edge is built.
    """
    kind = F.col("node_type")
    is_call = (kind == "Call") & (F.col("call_text") != "")
    edges = F.col("parent_seq").isNotNull().cast("int") + control_flow.edge_count() + F.coalesce(is_call, F.lit(False)).cast("int")
    return (
        syntax_rows(flat)
        .groupBy("file_id")
        .agg(
            F.count_if(kind.isin("FunctionDef", "AsyncFunctionDef")).alias("function_count"),
            F.count_if(kind == "ClassDef").alias("class_count"),
            F.count_if((kind == "alias") & F.col("parent_type").isin("Import", "ImportFrom")).alias("import_count"),
            (F.count("*") + 2 * F.count_if(control_flow.opens_scope())).alias("node_count"),
            (F.sum(edges) + F.coalesce(F.max("dfg_pairs"), F.lit(0))).alias("edge_count"),
            F.max("parse_ms").alias("parse_duration_ms"),
        )
    )


def measures() -> list[Column]:
    """Size and line count straight from the bytes."""
    size = F.length("content").cast("bigint").alias("size_bytes")
    return [size, line_count(F.col("content").cast("string")).alias("line_count")]


def file_stats(measured: DataFrame, flat: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per parsed file: the metadata payload. `measured` has file_id, size_bytes and line_count.

    Entities are counted where their rows are made; only external symbols, one per file and name, need the calls.
    """
    external = resolved.where(F.col("local_id").isNull()).groupBy("file_id").agg(F.count_distinct("qualified_name").alias("external"))
    return (
        syntax_counts(flat)
        .join(external, "file_id", "left")
        .withColumn("node_count", F.col("node_count") + F.coalesce("external", F.lit(0)))
        .join(measured.select("file_id", "size_bytes", "line_count"), "file_id")
        .select(
            "file_id",
            "size_bytes",
            "line_count",
            "function_count",
            "class_count",
            "import_count",
            "node_count",
            "edge_count",
            "parse_duration_ms",
            F.lit("SUCCESS").alias("parse_status"),
            F.lit(PARSER_NAME).alias("parser"),
        )
    )


def build_graph(sources: DataFrame, flat: DataFrame | None = None) -> Graph:
    """Graph of readable sources. Pass `flat`, with counts, when it was already written once for several consumers."""
    flat = flatten(sources, counted=True) if flat is None else flat
    resolved = calls.resolve_calls(flat)
    nodes, edges = graph_nodes(flat, resolved), graph_edges(flat, resolved)
    return Graph(nodes, edges, file_stats(sources.select("file_id", *measures()), flat, resolved), parse_errors(flat))
