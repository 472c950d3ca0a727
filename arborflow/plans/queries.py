"""Registered queries: every operator over the given tables."""

from pyspark.sql import functions as F

from arborflow.functions import ids
from arborflow.functions.paths import clean_path, path_problem
from arborflow.functions.text import line_count
from arborflow.operators import audit, calls, control_flow, data_flow, diff, events, fold, graph, manifest, metadata
from arborflow.operators import quality, state, syntax_graph, validate
from arborflow.operators.flatten import STATEMENTS, flatten, parse_errors
from arborflow.plans import derive
from arborflow.plans.derive import COMMIT, REPOSITORY, table
from arborflow.session import compact_files, empty_table, written
from arborflow.sources import records as keyed
from arborflow.sources.files import check_sources

TIME = "2026-01-01T00:00:00Z"


def _ids(spark, sf):
    files = derive.document_files(spark, sf)
    return files.select(
        "file_path",
        ids.file_id(REPOSITORY, F.col("file_path")).alias("file_id"),
        ids.content_hash(F.col("text")).alias("content_hash"),
    )


def _entity_ids(spark, sf):
    o = table(spark, sf, "orders")
    node = ids.node_id(F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit(None), F.col("o_orderkey"))
    edge = ids.edge_id(F.col("o_custkey"), "CALLS", F.col("o_orderkey"), F.concat(F.lit("call|"), "o_orderpriority"))
    return o.select("o_orderkey", node.alias("node_id"), edge.alias("edge_id"))


def _event_ids(spark, sf):
    e = derive.event_columns(spark, sf)
    return e.select(
        "event_id",
        ids.event_id(F.col("event_type"), F.col("user_id"), F.col("h")).alias("digest"),
        ids.generation_id(F.col("user_id").cast("string"), F.col("h")).alias("generation_id"),
    )


def _manifest(spark, sf):
    return manifest.build_manifest(derive.manifest_input(spark, sf), REPOSITORY, COMMIT)


SAMPLE_SCOPES = manifest.SCOPES | {"sample": manifest.Scope(parent="final", include=("src1*/**/*.py",), max_files=25)}


def _scope_limit(spark, sf):
    files = derive.manifest_input(spark, sf).select("file_path")
    return manifest.apply_scope(files, manifest.resolved("sample", SAMPLE_SCOPES))


def _path_contract(spark, sf):
    return manifest.path_contract(derive.document_files(spark, sf), position_col="doc_id")


def _path_normalize(spark, sf):
    raw = F.regexp_replace(F.regexp_replace("url", "^https:/", "."), "^http:/", "/")
    rows = table(spark, sf, "pages").select("page_id", F.regexp_replace(raw, "/en/", r"\\en\\").alias("raw"))
    return rows.select("page_id", path_problem(F.col("raw")).alias("problem"), clean_path(F.col("raw")).alias("path"))


def _out_of_order_offsets(spark, sf):
    e = derive.event_columns(spark, sf)
    rows = e.select(
        F.col("event_type").alias("topic"), F.length("h").alias("partition"), F.col("user_id").alias("key"),
        F.floor("value").alias("offset"), "event_id",
    )
    return audit.offset_order(rows, F.col("event_id"), ("topic", "key"), run_length=2048)


def _classified(spark, sf):
    return diff.classify(derive.document_versions(spark, sf), derive.document_state(spark, sf))


def _change_classification(spark, sf):
    return _classified(spark, sf).select("file_path", "change", "previous_hash")


def _unchanged_skip(spark, sf):
    return _classified(spark, sf).where("change = 'UNCHANGED'").select("file_path", "content_hash")


def _line_entities(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_id"),
        F.col("l_partkey").cast("string").alias("node_id"),
        "l_linestatus",
        "l_returnflag",
    )


def _removed(spark, sf):
    lines = _line_entities(spark, sf)
    return diff.removed_ids(lines, lines.where("l_linestatus = 'O'"), ["file_id", "node_id"])


def _snapshot(spark, sf):
    lines = _line_entities(spark, sf)
    _, upserts = diff.graph_diff(lines, lines.where("l_linestatus = 'O'"), ["file_id", "node_id"])
    return upserts.groupBy("file_id").agg(F.count("*").alias("upserts"))


def _order_files(spark, sf):
    """Orders as classified files."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.concat("o_orderkey", F.lit(".py")).alias("file_path"),
        F.col("o_orderpriority").alias("content_hash"),
        F.when(status != "O", F.lit("old")).alias("previous_hash"),
        F.when(status == "F", "UNCHANGED").when(status == "O", "NEW").otherwise("CHANGED").alias("change"),
    )


def _order_events(spark, sf):
    """All line items as event rows of their orders."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "NODE_UPSERT").when(flag == "N", "EDGE_UPSERT").otherwise("NODE_DELETE")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_id"),
        F.col("l_partkey").cast("string").alias("entity_id"),
        kind.alias("event_type"),
        F.when(flag == "N", "cpg.edges").otherwise("cpg.nodes").alias("topic"),
        F.when(flag == "A", 2).when(flag == "N", 3).otherwise(1).alias("position"),
    )


def _order_errors(spark, sf):
    rejected = table(spark, sf, "orders").where("o_totalprice < 20000")
    return rejected.select(F.col("o_orderkey").cast("string").alias("file_id"), F.lit("SyntaxError").alias("message"))


def _file_results(spark, sf):
    return events.file_results(_order_files(spark, sf), _order_events(spark, sf), _order_errors(spark, sf))


def _file_results_flat(spark, sf):
    counts = F.col("emitted_event_counts")
    return _file_results(spark, sf).select(
        "file_path", "status", "node_count", "edge_count", "error",
        counts["cpg.nodes"].alias("node_topic"), counts["cpg.edges"].alias("edge_topic"),
    )


def _replay_summary(spark, sf):
    lines = _line_entities(spark, sf)
    of = lambda flag, status: lines.where((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status))
    return diff.replay_summary(_order_files(spark, sf), of("R", "F"), of("A", "F"), of("N", "O"), of("A", "O"), _order_errors(spark, sf))


def _event_order(spark, sf):
    ordered = events.in_publish_order(_order_events(spark, sf))
    return ordered.select("file_id", "event_type", "entity_id", "sequence")


def _built_events(spark, sf):
    """Suppliers, customers and orders as removed, current and linked entities of nation files."""
    n = table(spark, sf, "nation")
    files = n.select(
        F.col("n_nationkey").cast("string").alias("file_id"),
        F.lit(REPOSITORY).alias("repository_id"),
        F.lit(COMMIT).alias("commit_sha"),
        F.concat("n_name", F.lit(".py")).alias("file_path"),
        F.col("n_name").alias("content_hash"),
        F.when(F.col("n_regionkey") > 1, F.lit("before")).alias("previous_hash"),
    )
    nothing = F.lit(None).cast("int")
    nodes = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("file_id"),
        F.col("c_custkey").cast("string").alias("node_id"),
        F.col("c_mktsegment").alias("node_type"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
        F.lit(None).cast("string").alias("qualified_name"),
        F.lit("Module").alias("ast_path"),
        F.length("c_name").alias("line_start"),
        *[nothing.alias(c) for c in ("column_start", "line_end", "column_end")],
        F.to_json(F.struct(F.col("c_mktsegment").alias("value_type"), (F.col("c_acctbal") > 0).alias("has_value"))).alias("properties"),
    )
    edges = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_nationkey").cast("string").alias("file_id"),
            F.col("o_orderkey").cast("string").alias("edge_id"),
            F.col("o_custkey").cast("string").alias("source_id"),
            F.col("o_orderstatus").alias("target_id"),
            F.lit("CALLS").alias("edge_type"),
            F.lit("{}").alias("properties"),
        )
    )
    metadata_rows = n.select(
        F.col("n_nationkey").cast("string").alias("file_id"),
        *[F.lit(i).cast("bigint").alias(c) for i, c in enumerate(metadata.METADATA_COUNTERS)],
        F.lit("SUCCESS").alias("parse_status"),
        F.lit("python.ast").alias("parser"),
    )
    s = table(spark, sf, "supplier")
    gone_nodes = s.select(F.col("s_nationkey").cast("string").alias("file_id"), F.col("s_name").alias("node_id"))
    gone_edges = s.where("s_acctbal < 0").select(F.col("s_nationkey").cast("string").alias("file_id"), F.col("s_name").alias("edge_id"))
    return events.build_events(files, nodes, edges, metadata_rows, gone_nodes, gone_edges, when=F.lit(TIME))


def _event_records(spark, sf):
    return _built_events(spark, sf).select("topic", "key", "event_type", "event_id", "value")


def _error_events(spark, sf):
    failed = _classified(spark, sf).where("change = 'FAILED'").select(
        "file_id", F.lit(REPOSITORY).alias("repository_id"), F.lit(COMMIT).alias("commit_sha"), "file_path",
        F.lit("0").alias("content_hash"), F.lit("ReadFileError").alias("error_type"), F.col("read_error").alias("message"),
    )
    return events.error_events(failed, F.lit(TIME)).select("topic", "key", "event_id", "value")


def _built_events_valid(spark, sf):
    """Our own events against our own contract, per type: all of them pass."""
    checked = validate.validate_events(_built_events(spark, sf))
    return checked.groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(F.size("violations") > 0).alias("invalid"))


def _publish_gate(spark, sf):
    e = derive.event_columns(spark, sf)
    bad = (F.col("event_type") == "error") & (F.col("value") > 150)
    rows = e.select(
        F.col("user_id").alias("file_id"), "event_id",
        F.when(bad, F.array(F.lit("type"))).otherwise(F.array().cast("array<string>")).alias("violations"),
    )
    return events.publish_gate(rows).select("event_id", "publishable")


def _contract(event_type, upsert, delete=None):
    def query(spark, sf):
        rows = derive.contract_records(spark, sf, event_type, upsert, delete)
        kinds = (upsert,) if delete is None else (upsert, delete)
        checked = validate.validate_events(rows, event_types=kinds)
        return checked.select("event_id", F.array_join("violations", "; ").alias("violations"))

    return query


def _validate_stream(spark, sf):
    """Events of all types in one stream, dispatched to their contracts."""
    rows = None
    for event_type, kinds in derive.CONTRACT_KINDS.items():
        part = derive.contract_records(spark, sf, event_type, *kinds)
        rows = part if rows is None else rows.unionByName(part)
    return validate.validate_events(rows).select("event_id", F.array_join("violations", "; ").alias("violations"))


def _non_finite(spark, sf):
    e = derive.event_columns(spark, sf)
    number = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(F.col("k") > 90, F.lit(float("-inf"))).otherwise(F.col("value"))
    return e.where(validate.non_finite(number)).groupBy("event_type").agg(F.count("*").alias("rejected"))


def _stream_audit(spark, sf):
    return audit.audit_stream(derive.audit_records(spark, sf))


def _expected_ids(spark, sf):
    return audit.audit_stream(derive.audit_records(spark, sf), expected_file_id="f8", expected_error_file_id="f9")


def _partition_consistency(spark, sf):
    return audit.partition_consistency(derive.audit_records(spark, sf))


def _offset_bounds(spark, sf):
    r = derive.audit_records(spark, sf)
    day = F.to_date("timestamp")
    return r.groupBy("topic", "partition").agg(
        F.min(F.when(day >= "2024-01-05", F.col("offset"))).alias("start_offset"),
        F.max(F.when(day < "2024-01-20", F.col("offset"))).alias("end_offset"),
    )


def _offset_window(spark, sf):
    inside = keyed.offset_window(derive.audit_records(spark, sf), _offset_bounds(spark, sf))
    return inside.groupBy("topic", "partition").agg(F.count("*").alias("records"), F.min("offset").alias("first"), F.max("offset").alias("last"))


def _offsets(spark, sf, until=None):
    r = derive.audit_records(spark, sf)
    r = r if until is None else r.where(F.to_date("timestamp") < until)
    return r.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def _offset_delta(spark, sf):
    return audit.offset_delta(_offsets(spark, sf, "2024-01-10"), _offsets(spark, sf))


def _lag(spark, sf):
    return audit.lag(_offsets(spark, sf), _offsets(spark, sf, "2024-01-25"))


def _set_difference(spark, sf):
    d = table(spark, sf, "documents")
    good = d.join(table(spark, sf, "labels").where("quality = 1"), "doc_id")
    return manifest.set_difference(d.select("source", "lang"), good.select("source", "lang"))


def _run_digests(spark, sf):
    """Each document as a run whose rows are its lines."""
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return manifest.same_runs(lines, "doc_id")


def _manifest_subset(spark, sf):
    full = _manifest(spark, sf).where("included")
    return manifest.missing_from(full, _scope_limit(spark, sf).where("included")).select("file_path")


def _metadata_flatten(spark, sf):
    return metadata.metadata_events(derive.metadata_records(spark, sf))


def _metadata_table(spark, sf):
    shape = empty_table(spark, metadata.TABLE_SCHEMA)
    return metadata.merge_metadata(shape, derive.metadata_records(spark, sf))


def _metadata_duplicates(spark, sf):
    return quality.metadata_duplicates(_metadata_flatten(spark, sf))


def _metadata_sample(spark, sf):
    return quality.metadata_sample(_metadata_table(spark, sf)).select("file_path", "size_bytes", "parse_status")


def _metadata_lookup(spark, sf):
    return quality.find_metadata(_metadata_table(spark, sf), file_path="u/8.py").select("file_path", "event_id", "size_bytes")


def _line_stats(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.octet_length("text").cast("bigint").alias("size_bytes"), line_count(F.col("text")).alias("line_count"))


def _read_rules(spark, sf):
    files = table(spark, sf, "pages").select(F.col("url").alias("file_path"), F.encode("html", "UTF-8").alias("content"))
    checked = check_sources(files, max_bytes=20_000)
    return checked.select("file_path", "read_error", F.length("content").cast("bigint").alias("size_bytes"))


def _folded_nodes(spark, sf):
    good, _ = fold.node_events(derive.node_records(spark, sf))
    empty = fold.empty_graph(spark)
    return fold.fold_nodes(empty["nodes"], empty["node_tombstones"], good)


def _folded_edges(spark, sf):
    good, _ = fold.edge_events(derive.edge_records(spark, sf))
    empty = fold.empty_graph(spark)
    return fold.fold_edges(empty["edges"], empty["edge_tombstones"], _folded_nodes(spark, sf), good)


def _node_fold(spark, sf):
    pairs = F.transform(F.map_entries("properties"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _folded_nodes(spark, sf).nodes.select("id", "name", "placeholder", "generation_id", F.array_join(F.array_sort(pairs), ",").alias("properties"))


def _node_tombstones(spark, sf):
    return _folded_nodes(spark, sf).tombstones


def _edge_fold(spark, sf):
    return _folded_edges(spark, sf).edges.select("edge_id", "source_id", "target_id", "generation_id")


def _edge_tombstones(spark, sf):
    return _folded_edges(spark, sf).tombstones.select("id", "generation_id", "file_id", "content_hash")


def _placeholders(spark, sf):
    nodes = _folded_edges(spark, sf).nodes.where("placeholder")
    return nodes.select("id", "file_id", "generation_id", "content_hash")


def _dead_letters(spark, sf):
    return _folded_edges(spark, sf).dead_letters.select("topic", "key", "reason", "seq")


def _dead_letters_of_long_histories(spark, sf):
    """The same by the way that long histories go, for all edges."""
    good, _ = fold.edge_events(derive.edge_records(spark, sf))
    empty = fold.empty_graph(spark)
    folded = fold.fold_edges(empty["edges"], empty["edge_tombstones"], _folded_nodes(spark, sf), good, run_length=1 << 12, short_history=0)
    return folded.dead_letters.select("topic", "key", "reason", "seq")


def _node_dead_letters(spark, sf):
    _, dead = fold.node_events(derive.faulty_node_records(spark, sf))
    return dead.select("topic", "key", "reason", "seq")


def _state(spark, sf):
    old = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("file_id"), F.lit(REPOSITORY).alias("repository_id"),
        F.col("c_name").alias("file_path"), F.col("c_mktsegment").alias("content_hash"),
    )
    return state.with_versions(old)


def _state_upsert(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("file_id"), F.lit("other").alias("repository_id"),
        F.col("p_name").alias("file_path"), F.col("p_brand").alias("content_hash"),
    )
    return state.commit_files(_state(spark, sf), parts).drop("updated_at")


def _state_delete(spark, sf):
    gone = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("file_id"))
    return state.drop_state(_state(spark, sf), gone).select("file_id", "file_path")


def _state_load(spark, sf):
    wanted = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("file_id"))
    return state.load_state(_state(spark, sf), wanted).select("file_id", "file_path", "parser_version")


def _entity_state(spark, sf):
    lines = _line_entities(spark, sf)
    committed = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("file_id"))
    committed = state.for_entities(committed, lines)
    old = lines.where("l_linestatus = 'F'").select("file_id", "node_id")
    kept = state.commit_entities(old, committed, lines.where("l_linestatus = 'O'").select("file_id", "node_id"))
    return kept.groupBy("file_id").agg(F.count("*").alias("entities"))


def _graph_counts(spark, sf):
    g = derive.graph_tables(spark, sf)
    return quality.graph_counts(g["nodes"], g["edges"], "7")


def _top_files(spark, sf):
    return quality.top_files(derive.graph_tables(spark, sf)["nodes"], "node_count")


def _duplicate_nodes(spark, sf):
    return quality.duplicate_ids(derive.graph_tables(spark, sf)["nodes"], "id")


def _top_files_edges(spark, sf):
    return quality.top_files(derive.graph_tables(spark, sf)["edges"], "edge_count")


def _duplicate_edges(spark, sf):
    return quality.duplicate_ids(derive.graph_tables(spark, sf)["edges"], ["edge_type", "file_id"])


def _null_properties_nodes(spark, sf):
    return quality.null_properties(derive.graph_tables(spark, sf)["nodes"], "id")


def _null_properties(spark, sf):
    return quality.null_properties(derive.graph_tables(spark, sf)["edges"], "edge_id")


def _open_placeholders(spark, sf):
    return quality.placeholders(derive.graph_tables(spark, sf)["nodes"]).groupBy("file_id").agg(F.count("*").alias("placeholders"))


def _tombstone_summary(spark, sf):
    g = derive.graph_tables(spark, sf)
    edges = g["edges"].select(F.col("edge_type").alias("id"), "generation_id", "file_id")
    return quality.tombstone_summary(g["nodes"].select("id", "generation_id", "file_id"), edges)


def _edge_types(spark, sf):
    return quality.edge_type_distribution(derive.graph_tables(spark, sf)["edges"])


# What the operators read of the flattened rows.
OWN = ("file_id", "seq", "node_type", "ast_path", "qualified_scope", "semantic_key")
PARENT = (*OWN, "field", "child_index", "parent_seq", "parent_type", "parent_scope", "parent_key")
SHOWN = (*OWN, "name", "line_start", "column_start", "line_end", "column_end", "value_type")
CONTROL = (*OWN, "has_else", "blocks")
DATA = (*OWN, "scope_seq", "scope_name", "reads")
IMPORTS = ("file_id", "seq", "depth", "node_type", "name", "parent_type", "alias_as", "import_module", "import_level")
SYMBOLS = (*OWN, "depth")
CALLS = (*OWN, *IMPORTS, "caller_type", "caller_scope", "caller_key", "caller_depth", "call_text")
DEFINED = ("FunctionDef", "AsyncFunctionDef", "ClassDef")


def _flat(spark, sf, columns, counted=False, types=None):
    return flatten(derive.spread(derive.document_sources(spark, sf)), counted, columns, types)


def _flat_once(spark, sf, columns, counted=False, types=None):
    """Written, for queries that use the rows more than once."""
    return written(_flat(spark, sf, columns, counted, types), "flat")


def _paths(spark, sf):
    return derive.document_sources(spark, sf).select("file_id", "file_path")


def _named(spark, sf, rows):
    return rows.join(_paths(spark, sf), "file_id").drop("file_id")


def _ast_nodes(spark, sf):
    flat = _flat_once(spark, sf, (*SHOWN, *CALLS, "blocks"))
    rows = graph.graph_nodes(flat).where("node_type <> 'ExternalSymbol'")
    return rows.select("node_id", "node_type", "name", "qualified_name", "ast_path", "properties")


def _ast_edges(spark, sf):
    compact_files(spark)  # three digests a row, and the most rows of all queries: over ten times the input otherwise
    return syntax_graph.ast_edges(_flat(spark, sf, PARENT)).select("edge_id", "source_id", "target_id", "properties")


def _cfg_edges(spark, sf):
    return control_flow.cfg_edges(_flat_once(spark, sf, CONTROL, types=STATEMENTS)).select("edge_id", "source_id", "target_id", "edge_type")


def _dfg_edges(spark, sf):
    flat = _flat(spark, sf, DATA, types=("Name", "arg", *DEFINED))
    return data_flow.dfg_edges(flat).select("edge_id", "source_id", "target_id", "properties")


def _called(spark, sf):
    return calls.resolve_calls(_flat_once(spark, sf, CALLS, types=("alias", "Call", *DEFINED)))


def _call_edges(spark, sf):
    rows = calls.call_edges(_called(spark, sf))
    return rows.select("edge_id", "source_id", "target_id", F.get_json_object("properties", "$.resolution_type").alias("resolution_type"))


def _external_symbols(spark, sf):
    rows = calls.external_symbols(_called(spark, sf))
    return rows.select("node_id", "name", "qualified_name", "ast_path", "properties")


def _imports(spark, sf):
    rows = calls.imports(_flat(spark, sf, IMPORTS, types=("alias",)))
    return _named(spark, sf, rows).select("file_path", "symbol", "qualified", "resolution")


def _local_symbols(spark, sf):
    rows = calls.local_symbols(_flat(spark, sf, SYMBOLS, types=DEFINED))
    return _named(spark, sf, rows).select("file_path", "symbol", "local_id")


def _parse_errors(spark, sf):
    flat = flatten(derive.spread(derive.document_sources(spark, sf, broken=True)), columns=("file_id", "seq", "error"), types=())
    return _named(spark, sf, parse_errors(flat)).select("file_path", F.substring_index("message", " in ", 1).alias("error"))


def _file_stats(spark, sf):
    flat = _flat_once(spark, sf, (*CALLS, "parent_seq", "has_else", "blocks", "dfg_pairs", "parse_ms"), counted=True)
    sources = derive.document_sources(spark, sf).select("file_id", *graph.measures())
    return _named(spark, sf, graph.file_stats(sources, flat, calls.resolve_calls(flat))).drop("parse_duration_ms")


def _edge_counts(spark, sf):
    rows = graph.graph_edges(_flat_once(spark, sf, (*PARENT, *CONTROL, *DATA, *CALLS)))
    return rows.groupBy("edge_type").agg(F.count("*").alias("edges"))


QUERIES = {
    "file_identity": _ids,
    "entity_ids": _entity_ids,
    "event_ids": _event_ids,
    "manifest_scoped": _manifest,
    "scope_limit": _scope_limit,
    "path_contract": _path_contract,
    "path_normalize": _path_normalize,
    "manifest_sizes": lambda spark, sf: manifest.manifest_sizes(_manifest(spark, sf)),
    "files_by_directory": lambda spark, sf: manifest.files_by_directory(_manifest(spark, sf)),
    "exclusion_reasons": lambda spark, sf: manifest.files_by_reason(_manifest(spark, sf)),
    "manifest_problems": lambda spark, sf: manifest.manifest_problems(_manifest(spark, sf), REPOSITORY, "other"),
    "manifest_subset": _manifest_subset,
    "set_difference": _set_difference,
    "run_digests": _run_digests,
    "read_rules": _read_rules,
    "change_classification": _change_classification,
    "unchanged_skip": _unchanged_skip,
    "graph_diff_removed": _removed,
    "full_snapshot_upsert": _snapshot,
    "replay_summary": _replay_summary,
    "file_results": _file_results_flat,
    "run_summary": lambda spark, sf: events.run_summary(_file_results(spark, sf)),
    "event_records": _event_records,
    "error_events": _error_events,
    "event_order": _event_order,
    "events_valid": _built_events_valid,
    "publish_gate": _publish_gate,
    "validate_node": _contract("view", "NODE_UPSERT", "NODE_DELETE"),
    "validate_edge": _contract("click", "EDGE_UPSERT", "EDGE_DELETE"),
    "validate_metadata": _contract("signup", "FILE_METADATA_UPSERT"),
    "validate_error": _contract("error", "PARSER_ERROR"),
    "validate_stream": _validate_stream,
    "nonfinite_reject": _non_finite,
    "stream_audit": _stream_audit,
    "audit_expected_ids": _expected_ids,
    "partition_consistency": _partition_consistency,
    "offset_order": _out_of_order_offsets,
    "offset_window": _offset_window,
    "offset_delta": _offset_delta,
    "consumer_lag": _lag,
    "metadata_flatten": _metadata_flatten,
    "metadata_latest": _metadata_table,
    "metadata_duplicates": _metadata_duplicates,
    "metadata_sample": _metadata_sample,
    "metadata_lookup": _metadata_lookup,
    "line_stats": _line_stats,
    "node_fold": _node_fold,
    "node_tombstones": _node_tombstones,
    "edge_fold": _edge_fold,
    "edge_tombstones": _edge_tombstones,
    "placeholders": _placeholders,
    "dead_letters": _dead_letters,
    "dead_letters_of_long_histories": _dead_letters_of_long_histories,
    "node_dead_letters": _node_dead_letters,
    "state_upsert": _state_upsert,
    "state_delete": _state_delete,
    "state_load": _state_load,
    "entity_state": _entity_state,
    "graph_counts": _graph_counts,
    "top_files": _top_files,
    "duplicate_ids": _duplicate_nodes,
    "null_properties": _null_properties,
    "null_properties_nodes": _null_properties_nodes,
    "top_files_edges": _top_files_edges,
    "duplicate_edges": _duplicate_edges,
    "open_placeholders": _open_placeholders,
    "tombstone_summary": _tombstone_summary,
    "edge_type_dist": _edge_types,
    "ast_nodes": _ast_nodes,
    "ast_child_edges": _ast_edges,
    "cfg_edges": _cfg_edges,
    "dfg_edges": _dfg_edges,
    "call_edges": _call_edges,
    "external_symbols": _external_symbols,
    "import_table": _imports,
    "local_symbols": _local_symbols,
    "parse_errors": _parse_errors,
    "file_stats": _file_stats,
    "edge_counts": _edge_counts,
}
