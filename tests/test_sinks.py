"""Manifest and event files, the graph stream, and work folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from arborflow import session
from arborflow.operators import events, fold, manifest
from arborflow.plans import derive
from arborflow.sources.records import RECORD_SCHEMA, read_json_lines, stream_records
from arborflow.sources.buckets import Change, Store, touched_buckets
from arborflow.streaming.graph import KEYS, fold_batch, graph_writer, read_graph


def test_manifest_file(spark, sf, tmp_path):
    files = manifest.build_manifest(derive.manifest_input(spark, sf), "docs", "c1")
    manifest.write_manifest(files, str(tmp_path / "manifest"))
    back = read_json_lines(spark, str(tmp_path / "manifest"), files.schema)
    assert manifest.set_difference(files, back).count() == 0
    with_names = files.where("included")
    manifest.assert_path_contract(with_names)
    with pytest.raises(ValueError, match="duplicates"):
        manifest.assert_path_contract(with_names.union(with_names.limit(2)))


def test_scopes():
    scopes = {"a": manifest.Scope(include=("x",), max_files=3), "b": manifest.Scope(parent="a", exclude=(("y", "no"),)), "c": manifest.Scope(parent="b", max_files=0)}
    assert manifest.resolved("c", scopes) == manifest.Scope(("x",), (("y", "no"),), None, 0)
    assert manifest.resolved("other", scopes) == manifest.Scope(manifest.ALL_PYTHON, ())


def test_event_files(spark, tmp_path):
    rows = spark.createDataFrame([("cpg.nodes", "f", json.dumps({"n": 1})), ("cpg.edges", "f", json.dumps({"n": 2}))], "topic string, key string, value string")
    for clean, copies in ((True, 1), (False, 2), (True, 1)):
        events.write_event_files(rows, str(tmp_path / "events"), clean)
        assert read_json_lines(spark, str(tmp_path / "events/topic=cpg.nodes"), "n int").collect() == [(1,)] * copies


def test_graph_stream_and_the_same_events_again(spark, sf, tmp_path):
    source, store, checkpoint = (str(tmp_path / name) for name in ("in", "graph", "checkpoint"))
    records = shaped(derive.node_records(spark, sf).where("offset < 200"))

    def drain():
        graph_writer(stream_records(spark, "parquet", source), checkpoint, store, check_keys=True, buckets=16, available_now=True).start().awaitTermination()
        return sorted(map(str, read_graph(spark, store)["nodes"].collect()))

    records.write.mode("append").parquet(source)
    first = drain()
    assert first and drain() == first
    records.write.mode("append").parquet(source)  # every event once more, as a new batch
    assert drain() == first


def shaped(records):
    columns = [part.split() for part in RECORD_SCHEMA.split(", ")]
    return records.select(*[(F.col(n) if n in records.columns else F.lit(None)).cast(kind).alias(n) for n, kind in columns])


def graph_of(spark, store):
    order = lambda props: F.array_join(F.array_sort(F.transform(F.map_entries(props), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    tables = read_graph(spark, store)
    return {n: sorted(map(str, (t.withColumn("properties", order("properties")) if "properties" in t.columns else t).collect())) for n, t in tables.items()}


def test_a_new_checkpoint_folds_new_records_and_skips_old_ones(spark, sf, tmp_path):
    """Progress is the store's own: offsets, not batch numbers."""
    source, store, again = (str(tmp_path / name) for name in ("in", "graph", "again"))
    records = shaped(derive.node_records(spark, sf)).unionByName(shaped(derive.edge_records(spark, sf))).where("offset < 200")
    parts = [records.where("offset < 120"), records.where("offset >= 120")]
    for part, checkpoint in zip(parts, ("one", "two")):  # the second checkpoint is new: it reads all files, as batch 0
        part.write.mode("append").parquet(source)
        graph_writer(stream_records(spark, "parquet", source), str(tmp_path / checkpoint), store, buckets=4, available_now=True).start().awaitTermination()
    for part in parts:
        fold_batch(part, again, buckets=4)
    found = graph_of(spark, store)
    assert found["nodes"] and found["edges"] and found == graph_of(spark, again)
    left = Store(spark, store, fold.GRAPH_TABLES, KEYS).new_records(records.unionByName(records.withColumn("offset", F.col("offset") + 200)))
    assert left.count() == records.where("offset >= 0").count()


def node_event(key, offset, content="h1"):
    body = {"event_type": "NODE_UPSERT", "repository_id": "r", "file_id": "f", "parser_version": "1.0.0", "schema_version": "1.0", "content_hash": content, "node": {"node_id": key, "node_type": "Name", "ast_path": "Module", "properties": {}}}
    return (key, json.dumps(body), "cpg.nodes", 0, offset, None)


def files_below(path):
    return {f"{folder}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_a_small_batch_rewrites_few_files(spark, tmp_path):
    store, buckets = str(tmp_path / "graph"), 128
    rows = [node_event(f"n{i}", i) for i in range(400)]
    fold_batch(spark.createDataFrame(rows, RECORD_SCHEMA), store, buckets=buckets)
    before = files_below(f"{store}/tables/nodes")
    assert len(before) > 100
    fold_batch(spark.createDataFrame([node_event(f"n{i}", 400 + i, "h2") for i in range(4)], RECORD_SCHEMA), store)
    after = files_below(f"{store}/tables/nodes")
    assert 0 < len(set(after.items()) - set(before.items())) <= 0.05 * len(before)
    hashes = {r.id: r.content_hash for r in read_graph(spark, store)["nodes"].collect()}
    assert len(hashes) == 400 and [hashes[f"n{i}"] for i in range(6)] == ["h2"] * 4 + ["h1"] * 2


def test_a_bucket_that_becomes_empty_and_a_crash_after_the_commit(spark, tmp_path, monkeypatch):
    schemas, keys, path = {"t": "id string, n int"}, {"t": "id"}, str(tmp_path / "store")
    open_store = lambda: Store(spark, path, schemas, keys, 4)
    rows = lambda *r: spark.createDataFrame(r, "id string, n int")
    of = lambda ids: touched_buckets(spark.createDataFrame([(i,) for i in ids], "id string"), 4)
    found = lambda: sorted(map(tuple, open_store().read()["t"].collect()))
    assert open_store().read()["t"].count() == 0
    open_store().commit({"t": Change(rows(("a", 1), ("b", 1), ("c", 1)), "id", of("abc"))})
    assert found() == [("a", 1), ("b", 1), ("c", 1)]
    left = [r for r in found() if not set(of([r[0]])) & set(of("a"))]
    open_store().commit({"t": Change(rows(("x", 0)).where("false"), "id", of("a"))})
    assert found() == left

    real = Store._apply

    def crash(self, version, tables):
        raise OSError("lost")

    monkeypatch.setattr(Store, "_apply", crash)
    with pytest.raises(OSError):
        open_store().commit({"t": Change(rows(("a", 2)), "id", of("a"))})
    monkeypatch.setattr(Store, "_apply", real)
    assert found() == sorted([*left, ("a", 2)]) and not os.listdir(f"{path}/staged")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    Context.getCheckpointDir = lambda self: "hdfs:///work"
    assert session.shared_folder(Session()) == "hdfs:///work" and not os.path.exists("hdfs:")
