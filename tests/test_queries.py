"""Registered queries against their SQL equivalents on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from arborflow.operators import state
from arborflow.plans.queries import QUERIES

# The rest is compared by the driver's own check; these cover each operator family quickly.
COMPARED = [
    "file_identity",
    "entity_ids",
    "event_ids",
    "manifest_scoped",
    "scope_limit",
    "path_contract",
    "path_normalize",
    "set_difference",
    "read_rules",
    "change_classification",
    "graph_diff_removed",
    "replay_summary",
    "file_results",
    "event_records",
    "event_order",
    "publish_gate",
    "validate_node",
    "validate_metadata",
    "validate_stream",
    "audit_expected_ids",
    "run_digests",
    "node_dead_letters",
    "dead_letters",
    "dead_letters_of_long_histories",
    "edge_fold",
    "run_summary",
    "offset_order",
    "offset_window",
    "offset_delta",
    "metadata_latest",
    "line_stats",
    "state_upsert",
    "tombstone_summary",
    "top_files",
]


@pytest.fixture(scope="module")
def database(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def sortable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registered.queries()) and set(QUERIES) <= set(registered.oracle_sql())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_query_matches_sql(spark, sf, database, name):
    made = registered.queries()[name](spark, sf)
    wanted = database.execute(registered.oracle_sql()[name])
    names = [c[0] for c in wanted.description]
    assert sorted(made.columns) == sorted(names)
    assert sortable(map(tuple, made.collect()), made.columns) == sortable(wanted.fetchall(), names)


def test_file_joins_follow_the_number_of_entities(spark, sf, monkeypatch):
    """entity_state: joins are dealt into as many tasks as the entities ask for, beyond the session's partitions."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    monkeypatch.setattr(state, "ENTITIES_A_TASK", lines // 30)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES["entity_state"](spark, sf)
        assert found.rdd.getNumPartitions() >= 30
        assert found.count() == found.distinct().count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
