"""What changed since the recorded state: per file and per graph entity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.constants import PARSER_VERSION, SCHEMA_VERSION


def classify(files: DataFrame, state: DataFrame, parser_version=PARSER_VERSION, schema_version=SCHEMA_VERSION):
    """Left join of the files (file_id, content_hash, read_error?) with the last state; adds `change`.

    A state row without versions predates them and forces a refresh.
    """
    previous = state.select(
        "file_id",
        F.lit(True).alias("_known"),
        F.col("content_hash").alias("previous_hash"),
        F.col("parser_version").alias("_parser"),
        F.col("schema_version").alias("_schema"),
    )
    failed = F.col("read_error").isNotNull() if "read_error" in files.columns else F.lit(False)
    current = F.coalesce((F.col("_parser") == parser_version) & (F.col("_schema") == schema_version), F.lit(False))
    change = (
        F.when(failed, "FAILED")
        .when(F.col("_known").isNull(), "NEW")
        .when(F.col("previous_hash") != F.col("content_hash"), "CHANGED")
        .when(current, "UNCHANGED")
        .otherwise("VERSION_REFRESH")
    )
    return files.join(previous, "file_id", "left").withColumn("change", change).drop("_known", "_parser", "_schema")


def removed_ids(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Recorded entities the current graph no longer has; nothing recorded, nothing removed.

    Repeats go after the join: for a small change Spark broadcasts the current ids, and the recorded ones stay where
    they are.
    """
    return previous.select(keys).join(current.select(keys), keys, "left_anti").distinct()


def graph_diff(previous: DataFrame, current: DataFrame, keys: list[str]):
    """(removed ids, full snapshot to upsert): unchanged entities are sent again so their fields stay fresh."""
    return removed_ids(previous, current, keys), current


def replay_summary(classified: DataFrame, removed_nodes, removed_edges, nodes, edges, errors=None) -> DataFrame:
    """Per file: status, old and new hash, and how many entities go and come."""
    parts = [
        part.select("file_id", *[F.lit(int(name == own)).alias(name) for name in _COUNTS])
        for own, part in zip(_COUNTS, (removed_nodes, removed_edges, nodes, edges))
    ]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    counts = counted.groupBy("file_id").agg(*[F.sum(name).alias(name) for name in _COUNTS])
    rows = classified.join(counts, "file_id", "left").fillna(0, _COUNTS)
    status = F.when(F.col("change") == "UNCHANGED", "SKIPPED_UNCHANGED").when(F.col("change") == "FAILED", "FAILED")
    error = F.lit(None).cast("string")
    if errors is not None:
        rows = rows.join(errors.select("file_id", F.col("message").alias("_message")), "file_id", "left")
        error = F.col("_message")
        status = status.when(error.isNotNull(), "FAILED")
    return rows.select(
        "file_id",
        "file_path",
        status.otherwise("SUCCESS").alias("status"),
        F.coalesce("previous_hash", F.lit("None")).alias("old_content_hash"),
        F.col("content_hash").alias("new_content_hash"),
        *_COUNTS,
        error.alias("error"),
    )


_COUNTS = ["removed_node_count", "removed_edge_count", "upsert_node_count", "upsert_edge_count"]
