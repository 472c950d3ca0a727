"""Folding node and edge events into graph tables.

Replaying events one by one per entity would put a hot entity's whole history into one task. The rules allow
more: only the last upsert, the deletes that hit the generation alive at their time, and the newest value of
each property decide the outcome, so the fold is made of aggregates that combine map-side plus one question
with an order in it, "which generation was alive when this delete arrived". That one is answered in two
levels: inside runs of consecutive records, then across runs by one row per run.

Rules of the data model kept here:
* a node delete counts only if the node is alive with the same generation, and then leaves a tombstone
* an edge delete always leaves a tombstone, and removes the edge only if its generation is the same
* an edge upsert is refused if its own generation has an edge tombstone, or an endpoint has a node tombstone
* an edge event naming other endpoints than the living edge's is a dead letter
* arrival order wins: versions are never compared; properties of successive upserts are merged

Results several later steps build on are written once to the shared folder: it keeps the plans short, does
each shuffle once, and lets a lost executor cost a re-read instead of the whole batch.
"""

from collections import namedtuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborflow.constants import DEAD_LETTER_TOPIC
from arborflow.functions import ids
from arborflow.functions.runs import sequence
from arborflow.operators.endpoints import foreign_endpoints
from arborflow.session import empty_table, written

NODE_TABLE = (
    "id string, placeholder boolean, node_type string, name string, qualified_name string, ast_path string,"
    " line_start int, column_start int, line_end int, column_end int, repository_id string, commit_sha string,"
    " file_path string, file_id string, parser_version string, schema_version string, content_hash string,"
    " generation_id string, properties map<string,string>"
)
EDGE_TABLE = (
    "edge_id string, source_id string, target_id string, edge_type string, repository_id string, file_id string,"
    " parser_version string, schema_version string, content_hash string, generation_id string,"
    " properties map<string,string>"
)
NODE_TOMBSTONE_TABLE = "id string, generation_id string, file_id string"
EDGE_TOMBSTONE_TABLE = (
    "id string, generation_id string, file_id string, content_hash string, parser_version string,"
    " schema_version string"
)
DEAD_LETTER_TABLE = "topic string, key string, value string, reason string, seq bigint"
GRAPH_TABLES = {
    "nodes": NODE_TABLE,
    "edges": EDGE_TABLE,
    "node_tombstones": NODE_TOMBSTONE_TABLE,
    "edge_tombstones": EDGE_TOMBSTONE_TABLE,
}
_ENVELOPE = (
    "event_type string, repository_id string, commit_sha string, file_path string, file_id string,"
    " parser_version string, schema_version string, content_hash string"
)
_NODE_EVENT = (
    f"{_ENVELOPE}, node struct<node_id:string,node_type:string,name:string,qualified_name:string,ast_path:string,"
    "line_start:int,column_start:int,line_end:int,column_end:int,properties:map<string,string>>"
)
_EDGE_EVENT = (
    f"{_ENVELOPE}, edge struct<edge_id:string,source_id:string,target_id:string,edge_type:string,"
    "properties:map<string,string>>"
)
# Consecutive records looked at together. A power of two, so a run never spans two stream partitions.
RUN_LENGTH = 1 << 17

FoldedNodes = namedtuple("FoldedNodes", "nodes tombstones detached")
FoldedEdges = namedtuple("FoldedEdges", "nodes edges tombstones dead_letters")


def empty_graph(spark) -> dict[str, DataFrame]:
    return {name: empty_table(spark, schema) for name, schema in GRAPH_TABLES.items()}


def _parsed(records: DataFrame, schema: str, payload: str, required: dict):
    """(well-formed events with seq and generation_id, dead letters)."""
    event = F.from_json("value", schema)
    rows = records.withColumn("event", event).withColumn("seq", sequence(F.col("partition"), F.col("offset")))
    lacking = F.when(F.try_parse_json("value").isNull() | F.col("event.event_type").isNull(), "malformed event")
    for event_type, fields in required.items():
        empty = F.lit(False)
        for field in fields:
            empty = empty | F.col(f"event.{payload}.{field}").isNull()
        lacking = lacking.when((F.col("event.event_type") == event_type) & empty, f"{event_type} without {', '.join(fields)}")
    rows = rows.withColumn("reason", lacking)
    # Every later step starts from these rows: parse each document once.
    rows = written(rows.select("topic", "key", "value", "reason", "seq", "event"), f"{payload}-events")
    dead = rows.where(F.col("reason").isNotNull()).select("topic", "key", "value", "reason", "seq")
    generation = ids.generation_id(*[F.col(c) for c in ("file_id", "content_hash", "parser_version", "schema_version")])
    good = (
        rows.where(F.col("reason").isNull() & F.col("event.event_type").isin(*required))
        .select("topic", "key", "value", "seq", "event.*")
        .select("*", f"{payload}.*")
        .drop(payload)
        .withColumn("generation_id", generation)
    )
    return good, dead


def node_events(records: DataFrame):
    """Node events of keyed records, and the records that are none. A delete without an id finds nothing."""
    good, dead = _parsed(records, _NODE_EVENT, "node", {"NODE_UPSERT": ["node_id"], "NODE_DELETE": []})
    return good.where("node_id IS NOT NULL"), dead


def edge_events(records: DataFrame):
    upsert = ["edge_id", "source_id", "target_id"]
    return _parsed(records, _EDGE_EVENT, "edge", {"EDGE_UPSERT": upsert, "EDGE_DELETE": ["edge_id"]})


def matching_deletes(rows: DataFrame, key: str, run_length=RUN_LENGTH) -> DataFrame:
    """Deletes whose generation is that of the last upsert before them.

    `rows`: key, is_delete, generation_id, seq. A repeated delete of a generation already gone is returned too;
    it changes nothing, as no upsert lies between.
    """
    slim = rows.select(key, "is_delete", "generation_id", "seq").withColumn("run", F.floor(F.col("seq") / run_length))
    made = F.when(~F.col("is_delete"), F.col("generation_id"))
    inside = Window.partitionBy(key, "run").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deletes = slim.withColumn("alive", F.last(made, ignorenulls=True).over(inside)).where("is_delete")
    earlier = Window.partitionBy(key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        slim.groupBy(key, "run")
        .agg(F.max_by(made, F.when(~F.col("is_delete"), F.col("seq"))).alias("left_alive"))
        .withColumn("carried", F.last("left_alive", ignorenulls=True).over(earlier))
        .where(F.col("carried").isNotNull())
        .select(key, "run", "carried")
    )
    return (
        deletes.join(runs, [key, "run"], "left")
        .where(F.coalesce("alive", "carried") == F.col("generation_id"))
        .select(key, "generation_id", "seq")
    )


def _merged_properties(upserts: DataFrame, key: str, reserved) -> DataFrame:
    """Newest value of each property: (key, entries of (name, value, seq)). As many entries as property names."""
    entries = (
        upserts.where(F.size("properties") > 0)
        .select(key, "seq", F.explode("properties").alias("property", "value"))
        .where(~F.col("property").isin(*reserved))
        .groupBy(key, "property")
        .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("set_at"))
    )
    return entries.groupBy(key).agg(F.collect_list(F.struct("property", "value", "set_at")).alias("entries"))


def _settled(upserts: DataFrame, deletes: DataFrame, key: str, columns: list[str], reserved) -> DataFrame:
    """Entities alive after all upserts and matching deletes, with their table columns."""
    fields = [c for c in columns if c not in (key, "properties")]
    last = upserts.groupBy(key).agg(F.max_by(F.struct(*fields), "seq").alias("last"), F.max("seq").alias("last_seq"))
    gone = deletes.groupBy(key).agg(F.max("seq").alias("gone_seq"))
    since = F.coalesce("gone_seq", F.lit(-2))
    kept = F.filter(F.coalesce("entries", F.array()), lambda e: (e["set_at"] > since) & e["value"].isNotNull())
    pairs = F.transform(kept, lambda e: F.struct(e["property"], e["value"]))
    return (
        last.join(gone, key, "left")
        .where(since < F.col("last_seq"))
        .join(_merged_properties(upserts, key, reserved), key, "left")
        .withColumn("properties", F.map_from_entries(pairs))
        .select(*[F.col(c) if c in (key, "properties") else F.col(f"last.{c}").alias(c) for c in columns])
    )


def fold_nodes(nodes: DataFrame, tombstones: DataFrame, events: DataFrame, run_length=RUN_LENGTH) -> FoldedNodes:
    """Apply node events to the node table; `detached` are the nodes deleted on the way."""
    columns = nodes.columns
    touched = events.select(F.col("node_id").alias("id")).distinct()
    # What is stored enters as an upsert before every event.
    stored = nodes.join(touched, "id", "left_semi").select(*columns, F.lit(-1).cast("bigint").alias("seq"), F.lit(False).alias("is_delete"))
    arrived = events.select(
        *[F.col("node_id").alias("id") if c == "id" else F.lit(False).alias(c) if c == "placeholder" else F.col(c) for c in columns],
        "seq",
        (F.col("event_type") == "NODE_DELETE").alias("is_delete"),
    )
    rows = stored.unionByName(arrived)
    deletes = written(matching_deletes(rows, "id", run_length), "node-deletes")
    settled = _settled(rows.where("NOT is_delete"), deletes, "id", columns, columns)
    # A generation starts with its file_id.
    buried = deletes.select("id", "generation_id").distinct().join(tombstones, ["id", "generation_id"], "left_anti")
    buried = buried.withColumn("file_id", F.regexp_extract("generation_id", "^(.*):[^:]*:[^:]*:[^:]*$", 1))
    return FoldedNodes(
        nodes.join(touched, "id", "left_anti").unionByName(settled).select(columns),
        tombstones.unionByName(buried).select(tombstones.columns),
        deletes.select("id").distinct(),
    )


def detach(edges: DataFrame, detached: DataFrame) -> DataFrame:
    """Edges without those of a deleted endpoint."""
    for end in ("source_id", "target_id"):
        edges = edges.join(detached.select(F.col("id").alias(end)), end, "left_anti")
    return edges


def mark_entombed_endpoints(events: DataFrame, node_tombstones: DataFrame) -> DataFrame:
    """Add `entombed`: an endpoint has a node tombstone of the event's generation.

    The generation names one version of one file, so the join keys are as spread as the files are.
    """
    buried = node_tombstones.select("id", "generation_id").distinct()
    for end in ("source_id", "target_id"):
        side = buried.select(F.col("id").alias(end), "generation_id", F.lit(True).alias(f"_{end}"))
        events = events.join(side, [end, "generation_id"], "left")
    marked = F.coalesce("_source_id", "_target_id", F.lit(False))
    return events.withColumn("entombed", marked).drop("_source_id", "_target_id")


def fold_edges(
    edges: DataFrame, tombstones: DataFrame, folded: FoldedNodes, events: DataFrame, run_length=RUN_LENGTH, short_history=None
) -> FoldedEdges:
    """Apply edge events after the node fold of the same batch; short_history: see foreign_endpoints."""
    columns = edges.columns
    remaining = detach(edges, folded.detached)
    touched = events.select("edge_id").distinct()
    stored = remaining.join(touched, "edge_id", "left_semi").select(
        *columns,
        F.lit(-1).cast("bigint").alias("seq"),
        F.lit(False).alias("is_delete"),
        F.lit(False).alias("entombed"),
        *[F.lit(None).cast("string").alias(c) for c in ("topic", "key", "value")],
    )
    arrived = mark_entombed_endpoints(events, folded.tombstones).select(
        *columns, "seq", (F.col("event_type") == "EDGE_DELETE").alias("is_delete"), "entombed", "topic", "key", "value"
    )
    arrived = written(arrived, "edge-events")
    rows = stored.unionByName(arrived)
    foreign = written(foreign_endpoints(rows, tombstones, run_length, short_history), "foreign-endpoints")
    dead = arrived.join(foreign, ["edge_id", "seq"], "left_semi").select(
        F.lit(DEAD_LETTER_TOPIC).alias("topic"),
        "key",
        "value",
        F.lit("edge endpoints differ from the stored edge").alias("reason"),
        "seq",
    )
    sound = rows.join(foreign, ["edge_id", "seq"], "left_anti").where("NOT entombed")

    # The first delete of a generation closes it for good: later upserts of that generation are refused.
    deletes = sound.where("is_delete")
    pair = ["edge_id", "generation_id"]
    first = deletes.groupBy(*pair).agg(
        F.min("seq").alias("closed_at"),
        F.min_by(F.struct("file_id", "content_hash", "parser_version", "schema_version"), "seq").alias("by"),
    )
    first = written(first, "edge-closings")
    old = tombstones.select(F.col("id").alias("edge_id"), "generation_id")
    closed = (
        first.select(*pair, "closed_at")
        .unionByName(old.withColumn("closed_at", F.lit(-1).cast("bigint")))
        .groupBy(*pair)
        .agg(F.min("closed_at").alias("closed_at"))
    )
    applied = (
        sound.where("NOT is_delete")
        .join(closed, pair, "left")
        .where(F.col("closed_at").isNull() | (F.col("closed_at") >= F.col("seq")))
    )
    applied = written(applied.drop("topic", "key", "value", "closed_at"), "edge-upserts")
    closings = first.select(*pair, F.col("closed_at").alias("seq"), F.lit(True).alias("is_delete"))
    hits = matching_deletes(applied.select(*pair, "seq", "is_delete").unionByName(closings), "edge_id", run_length)
    settled = _settled(applied, hits, "edge_id", columns, columns)
    buried = first.select(F.col("edge_id").alias("id"), "generation_id", "by.*").join(
        tombstones, ["id", "generation_id"], "left_anti"
    )
    return FoldedEdges(
        with_placeholders(folded.nodes, applied.where("seq >= 0")),
        remaining.join(touched, "edge_id", "left_anti").unionByName(settled).select(columns),
        tombstones.unionByName(buried).select(tombstones.columns),
        dead,
    )


def placeholders(nodes: DataFrame, applied: DataFrame) -> DataFrame:
    """Stand-ins for endpoints of applied edges that are not there; the first edge to name one describes it."""
    known = ["file_id", "generation_id", "content_hash", "parser_version", "schema_version", "repository_id"]
    ends = applied.select(F.explode(F.array("source_id", "target_id")).alias("id"), "seq", F.struct(*known).alias("first"))
    named = ends.groupBy("id").agg(F.min_by("first", "seq").alias("first")).join(nodes.select("id"), "id", "left_anti")
    shape = T.StructType.fromDDL(NODE_TABLE)
    values = {"id": F.col("id"), "placeholder": F.lit(True), "properties": F.create_map().cast("map<string,string>")}
    values |= {c: F.col(f"first.{c}") for c in known}
    return named.select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in shape])


def with_placeholders(nodes: DataFrame, applied: DataFrame) -> DataFrame:
    return nodes.unionByName(placeholders(nodes, applied))


def fold_graph(graph: dict[str, DataFrame], node_records: DataFrame, edge_records: DataFrame, run_length=RUN_LENGTH):
    """One batch of both topics onto the four graph tables: (new tables, dead letters)."""
    return fold_events(graph, node_events(node_records), edge_events(edge_records), run_length)


def fold_events(graph: dict[str, DataFrame], of_nodes, of_edges, run_length=RUN_LENGTH):
    """The same from what node_events and edge_events return. The tables need to hold what touched_keys names only."""
    n_events, n_dead = of_nodes
    e_events, e_dead = of_edges
    nodes = fold_nodes(graph["nodes"], graph["node_tombstones"], n_events, run_length)
    edges = fold_edges(graph["edges"], graph["edge_tombstones"], nodes, e_events, run_length)
    tables = {
        "nodes": edges.nodes,
        "edges": edges.edges,
        "node_tombstones": nodes.tombstones,
        "edge_tombstones": edges.tombstones,
    }
    routed = n_dead.unionByName(e_dead).withColumn("topic", F.lit(DEAD_LETTER_TOPIC))
    return tables, routed.unionByName(edges.dead_letters)


def touched_keys(edges: DataFrame, n_events: DataFrame, e_events: DataFrame) -> dict[str, DataFrame]:
    """Keys that a fold of the events may read or change, per table; `edges` are all stored ones.

    Nodes: those with events and the ends of edges with events. Edges: those with events and those that end in a node
    with a delete.
    """
    ends = e_events.select(F.explode(F.array("source_id", "target_id")).alias("id"))
    nodes = n_events.select(F.col("node_id").alias("id")).unionByName(ends).distinct()
    deleted = n_events.where("event_type = 'NODE_DELETE'").select("node_id").distinct()
    own = e_events.select("edge_id")
    for end in ("source_id", "target_id"):
        own = own.unionByName(edges.select("edge_id", F.col(end).alias("node_id")).join(deleted, "node_id", "left_semi").select("edge_id"))
    own = own.distinct()
    return {"nodes": nodes, "node_tombstones": nodes, "edges": own, "edge_tombstones": own}
