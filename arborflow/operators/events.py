"""Graph changes as keyed, ordered events, and the results counted from them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborflow.constants import (
    ENVELOPE_FIELDS,
    EVENT_ORDER,
    METADATA_FIELDS,
    PARSER_VERSION,
    SCHEMA_VERSION,
    TOPIC_BY_EVENT,
)
from arborflow.functions import ids

NODE_FIELDS = ["node_id", "node_type", "name", "qualified_name", "ast_path"]
POSITION_FIELDS = ["line_start", "column_start", "line_end", "column_end"]
EDGE_FIELDS = ["edge_id", "source_id", "target_id", "edge_type"]
EVENT_COLUMNS = ["topic", "key", "value", "event_type", "entity_id", "event_id", "file_id", "position"]
UTC_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def event_time():
    """The moment of the query, in whole UTC seconds."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp()), UTC_SECONDS)


def envelopes(rows: DataFrame, event_type: str, entity: str, payload: str, body, content_hash, when=None) -> DataFrame:
    """Wrap rows (file_id, repository_id, commit_sha, file_path and the body's columns) into event records."""
    stamped = rows.withColumns(
        {
            "entity_id": F.col(entity),
            "event_type": F.lit(event_type),
            "content_hash": content_hash,
            "schema_version": F.lit(SCHEMA_VERSION),
            "parser_version": F.lit(PARSER_VERSION),
            "event_time": when if when is not None else event_time(),
        }
    ).withColumn("event_id", ids.event_id(event_type, F.col("entity_id"), F.col("content_hash")))
    # Nulls are part of the contract ("name": null), so they are written.
    value = F.to_json(F.struct(*ENVELOPE_FIELDS, body.alias(payload)), {"ignoreNullFields": "false"})
    rank = F.lit(EVENT_ORDER.index(event_type) if event_type in EVENT_ORDER else 0)
    return stamped.select(
        F.lit(TOPIC_BY_EVENT[event_type]).alias("topic"),
        F.col("file_id").alias("key"),
        value.alias("value"),
        "event_type",
        "entity_id",
        "event_id",
        "file_id",
        rank.alias("position"),
    )


def build_events(files: DataFrame, nodes, edges, metadata, removed_nodes, removed_edges, when=None) -> DataFrame:
    """All events of the parsed files.

    `files` has file_id, repository_id, commit_sha, file_path, content_hash, previous_hash: a few hundred bytes
    per file, so Spark may broadcast it when it is small and shuffles by file_id when it is not.
    Deletes carry the hash of the content that made the entity, with the current versions.
    """
    now = F.col("content_hash")
    before = F.coalesce("previous_hash", "content_hash")
    parsed = lambda name: F.parse_json(F.col(name))
    node = F.struct(*NODE_FIELDS, *POSITION_FIELDS, parsed("properties").alias("properties"))
    edge = F.struct(*EDGE_FIELDS, parsed("properties").alias("properties"))
    of_file = lambda rows: rows.join(files, "file_id")
    return (
        envelopes(of_file(removed_edges), "EDGE_DELETE", "edge_id", "edge", F.struct("edge_id"), before, when)
        .unionByName(envelopes(of_file(removed_nodes), "NODE_DELETE", "node_id", "node", F.struct("node_id"), before, when))
        .unionByName(envelopes(of_file(nodes), "NODE_UPSERT", "node_id", "node", node, now, when))
        .unionByName(envelopes(of_file(edges), "EDGE_UPSERT", "edge_id", "edge", edge, now, when))
        .unionByName(
            envelopes(of_file(metadata), "FILE_METADATA_UPSERT", "file_id", "metadata", F.struct(*METADATA_FIELDS), now, when)
        )
    )


def error_events(failures: DataFrame, when=None) -> DataFrame:
    """One PARSER_ERROR per failed file; `failures` has the file columns plus error_type and message."""
    body = F.struct(
        "error_type",
        "message",
        F.lit(None).cast("int").alias("line"),
        F.lit(None).cast("int").alias("column"),
        F.lit(False).alias("retryable"),
    )
    return envelopes(failures, "PARSER_ERROR", "file_id", "error", body, F.col("content_hash"), when)


def in_publish_order(events: DataFrame) -> DataFrame:
    """Number each file's events: deletes before upserts, edges' deletes first, metadata last.

    The window sorts a file's events on disk and streams them.
    """
    order = Window.partitionBy("file_id").orderBy("position", "entity_id")
    return events.withColumn("sequence", F.row_number().over(order))


def publish_gate(events: DataFrame, violations="violations") -> DataFrame:
    """Add `publishable`: false for every event of a file that has an invalid one.

    The files with a violation are few and distinct; the events themselves are not regrouped.
    """
    bad = events.where(F.size(violations) > 0).select("file_id", F.lit(False).alias("publishable")).distinct()
    return events.join(bad, "file_id", "left").withColumn("publishable", F.coalesce("publishable", F.lit(True)))


def publish(events: DataFrame, fmt="kafka", path=None, mode="append", **options) -> None:
    """Write keyed records, each file's in publish order. Folder formats get one directory per topic."""
    # Folder formats write one topic after the other, which sorts by topic: so the topic leads here as well.
    ordered = events.repartition("key").sortWithinPartitions("topic", "key", "position", "entity_id")
    if fmt == "kafka":
        ordered.select("topic", "key", "value").write.format("kafka").options(**options).save()
        return
    ordered.select("topic", "key", "value").write.partitionBy("topic").mode(mode).format(fmt).options(**options).save(path)


def write_event_files(events: DataFrame, path: str, clean=False) -> None:
    """Dry run: one folder of JSON lines per topic."""
    events.select("topic", "value").write.partitionBy("topic").mode("overwrite" if clean else "append").text(path)


def file_results(classified: DataFrame, events: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per file: status, entity counts and events per topic. `errors` are parse failures (file_id, message)."""
    per_topic = (
        events.groupBy("file_id", "topic")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("event_type") == "NODE_UPSERT").alias("nodes"),
            F.count_if(F.col("event_type") == "EDGE_UPSERT").alias("edges"),
        )
        .groupBy("file_id")
        .agg(
            # At most one entry per topic.
            F.map_from_entries(F.collect_list(F.struct("topic", "n"))).alias("emitted_event_counts"),
            F.sum("nodes").alias("node_count"),
            F.sum("edges").alias("edge_count"),
        )
    )
    rows = classified.join(per_topic, "file_id", "left")
    error = F.col("read_error") if "read_error" in classified.columns else F.lit(None).cast("string")
    if errors is not None:
        rows = rows.join(errors.select("file_id", F.col("message").alias("_message")), "file_id", "left")
        error = F.coalesce(error, F.col("_message"))
    status = (
        F.when(error.isNotNull() | (F.col("change") == "FAILED"), "FAILED")
        .when(F.col("change") == "UNCHANGED", "SKIPPED_UNCHANGED")
        .otherwise("SUCCESS")
    )
    return rows.select(
        "file_id",
        "file_path",
        "content_hash",
        status.alias("status"),
        F.coalesce("node_count", F.lit(0)).alias("node_count"),
        F.coalesce("edge_count", F.lit(0)).alias("edge_count"),
        F.coalesce("emitted_event_counts", F.create_map().cast("map<string,bigint>")).alias("emitted_event_counts"),
        error.alias("error"),
    )


def run_summary(results: DataFrame, discovered=None) -> DataFrame:
    """One row over all files. `discovered` counts the included files before a run limit."""
    emitted = lambda topic: F.coalesce(F.sum(F.col("emitted_event_counts")[topic]), F.lit(0))
    return results.agg(
        (F.lit(discovered) if discovered is not None else F.count("*")).cast("bigint").alias("discovered"),
        F.count("*").alias("eligible"),
        F.count_if(F.col("status") == "SUCCESS").alias("processed"),
        F.count_if(F.col("status") == "SKIPPED_UNCHANGED").alias("skipped_unchanged"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        emitted("cpg.nodes").alias("node_events"),
        emitted("cpg.edges").alias("edge_events"),
        emitted("source.metadata").alias("metadata_events"),
        F.count_if(F.col("status") == "FAILED").alias("error_events"),
    )
