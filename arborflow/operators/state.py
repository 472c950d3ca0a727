"""Recorded state: one row per file, plus the ids of its nodes and edges as rows."""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.constants import PARSER_VERSION, SCHEMA_VERSION
from arborflow.session import empty_table

FILE_STATE = (
    "file_id string, repository_id string, file_path string, content_hash string, updated_at timestamp,"
    " parser_version string, schema_version string"
)
NODE_STATE = "file_id string, node_id string"
EDGE_STATE = "file_id string, edge_id string"
STATE_TABLES = {"files": FILE_STATE, "nodes": NODE_STATE, "edges": EDGE_STATE}
# Entities that a task is to sort at a time.
ENTITIES_A_TASK = 1 << 18


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: empty_table(spark, schema) for name, schema in STATE_TABLES.items()}


def with_versions(old: DataFrame) -> DataFrame:
    """State written before versions were kept: the missing columns become NULL, which forces a refresh."""
    shape = empty_table(old.sparkSession, FILE_STATE)
    return shape.unionByName(old, allowMissingColumns=True)


def load_state(state: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each wanted file_id with its last state, NULL where it has none."""
    return wanted.select("file_id").join(state, "file_id", "left")


def upsert(table: DataFrame, changes: DataFrame, key="file_id", keep_first=()) -> DataFrame:
    """Replace rows by key, insert new ones; `keep_first` columns keep the value of the first insert.

    `changes` has at most one row per key. Only what a changed row takes over from its old one is looked up; the
    other old rows pass an anti-join. On a table that is known to be empty both joins vanish from the plan.
    """
    missing = [c for c in table.columns if c not in changes.columns]
    taken = [*keep_first, *missing]
    fresh = changes
    if taken:
        old = table.select(key, *[F.col(c).alias(f"_old_{c}") for c in taken])
        fresh = changes.join(old, key, "left")
        fresh = fresh.withColumns({c: F.coalesce(f"_old_{c}", c) if c in keep_first else F.col(f"_old_{c}") for c in taken})
    kept = table.join(changes.select(key), key, "left_anti")
    return fresh.select(table.columns).unionByName(kept)


def commit_files(state: DataFrame, committed: DataFrame) -> DataFrame:
    """Record published files (file_id, repository_id, file_path, content_hash) under the current versions."""
    rows = committed.select(
        "file_id",
        "repository_id",
        "file_path",
        "content_hash",
        F.current_timestamp().alias("updated_at"),
        F.lit(PARSER_VERSION).alias("parser_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    return upsert(state, rows, keep_first=("repository_id", "file_path"))


def for_entities(files: DataFrame, entities: DataFrame) -> DataFrame:
    """Files (file_id) dealt for joins with so many entities: what a task sorts there does not grow with the tables.

    The side of the files is dealt, as an entity side would lose it again: semi and anti joins move below it.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(cores, math.ceil(entities.count() / ENTITIES_A_TASK)), "file_id")


def commit_entities(state: DataFrame, committed: DataFrame, current: DataFrame) -> DataFrame:
    """Replace the ids of the committed files by their current ones."""
    kept = state.join(committed.select("file_id"), "file_id", "left_anti")
    fresh = current.select(state.columns).join(committed.select("file_id"), "file_id", "left_semi")
    return kept.unionByName(fresh).select(state.columns)


def commit_state(state: dict[str, DataFrame], committed: DataFrame, nodes, edges) -> dict[str, DataFrame]:
    return {
        "files": commit_files(state["files"], committed),
        "nodes": commit_entities(state["nodes"], committed, nodes),
        "edges": commit_entities(state["edges"], committed, edges),
    }


def drop_state(state: DataFrame, gone: DataFrame) -> DataFrame:
    return state.join(gone.select("file_id"), "file_id", "left_anti")
