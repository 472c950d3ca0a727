"""Working tree -> events -> state and graph, over several runs."""

import hashlib
import json
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from arborflow.operators import diff, events, state
from arborflow.operators.flatten import flatten
from arborflow.plans import pipeline
from arborflow.session import work_tables, written
from arborflow.sources.files import measure_sources, read_sources, resolve_root, scan_files
from arborflow.sources.files import scan_files as list_files
from arborflow.streaming.graph import fold_batch, read_dead_letters, read_graph

FILES = {
    "src/main.py": "def run(x):\n    return x\n\n\nrun(1)\n",
    "src/__init__.py": "",
    ".github/tool.py": "a = 1\n",
    "tests/test_main.py": "assert True\n",
    "setup.py": "pass\n",
    "src/generated/client_pb2.py": "pass\n",
    ".git/hook.py": "pass\n",
    "README.md": "text\n",
}


@pytest.fixture()
def tree(tmp_path):
    for name, text in FILES.items():
        target = tmp_path / "tree" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    return tmp_path / "tree"


def test_scan_and_manifest(spark, tree):
    found = sorted(r.file_path for r in scan_files(spark, str(tree)).collect())
    assert found == sorted(p for p in FILES if p.endswith(".py") and not p.startswith(".git/"))
    rows = {r.file_path: r for r in pipeline.discover(spark, str(tree), "demo", "c1").collect()}
    assert {p for p, r in rows.items() if r.included} == {"src/main.py", "src/__init__.py", ".github/tool.py"}
    assert rows["tests/test_main.py"].exclusion_reason == "Excluded test file"
    assert rows["setup.py"].exclusion_reason == "Excluded setup/build file"
    assert rows["src/generated/client_pb2.py"].exclusion_reason == "Excluded generated file"
    smoke = pipeline.discover(spark, str(tree), "demo", "c1", scope="smoke").where("included").collect()
    assert sorted(r.file_path for r in smoke) == ["src/__init__.py", "src/main.py"]
    with pytest.raises(ValueError, match="outside"):
        resolve_root(str(tree), "..")
    with pytest.raises(FileNotFoundError):
        resolve_root(str(tree), "nowhere")


@pytest.mark.parametrize("budget", [3, 20_000])
def test_listing_in_rounds(spark, tmp_path, budget):
    """A deep chain, a wide folder and a wide tree, from a plain path and from a URI."""
    top = tmp_path / "wide"
    for folder in ["/".join("abcdefgh"), "flat", *[f"t{i}/{j}" for i in range(4) for j in range(3)], ".git", "__pycache__"]:
        (top / folder).mkdir(parents=True)
        for i in range(40 if folder == "flat" else 1):
            (top / folder / f"_f{i}.py").write_text("x = 1\n")
    (top / "flat" / "dangling.py").symlink_to(top / "nowhere")
    (top / "loop").symlink_to(top)
    want = sorted(str(p.relative_to(top)) for p in top.rglob("*.py") if not {".git", "__pycache__"} & set(p.relative_to(top).parts) and "loop" not in p.parts)
    scan_files = partial(list_files, prune={".git", "__pycache__"})
    rows = scan_files(spark, str(top), budget=budget).collect()
    assert sorted(r.file_path for r in rows) == want
    assert {r.file_path: r.size_bytes for r in rows}["flat/dangling.py"] == 0
    inside = sorted(r.file_path for r in scan_files(spark, f"file://{top}", "t1", budget=budget).collect())
    assert inside == [p for p in want if p.startswith("t1/")]
    measured = measure_sources(scan_files(spark, f"file://{top}", "t1", budget=budget), f"file://{top}").collect()
    assert {(r.line_count, r.read_error) for r in measured} == {(1, None)}
    assert read_sources(scan_files(spark, f"file://{top}", "t1"), f"file://{top}").first().content == b"x = 1\n"


def test_one_wide_folder_spreads(spark, tmp_path):
    for i in range(3_000):
        (tmp_path / f"f{i}.py").touch()
    found = scan_files(spark, str(tmp_path))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 0.5 * 3_000


def kept(run):
    return {name: written(table, f"state-{name}") for name, table in run.state.items()}


def totals(run):
    return run.summary.first().asDict()


def records_of(run):
    rows = run.events.select("key", "value", "topic", F.lit(0).alias("partition"), F.lit(None).cast("timestamp").alias("timestamp"))
    order = F.pmod(F.xxhash64("value"), F.lit(1 << 40))
    return rows.select("key", "value", "topic", "partition", order.alias("offset"), "timestamp")


def test_incremental_runs(spark, tree, tmp_path):
    run = lambda before, **more: pipeline.process(pipeline.tree_sources(spark, str(tree), "demo", "c1"), before, **more)
    sent = []
    first = run(state.empty_state(spark), publish=sent.append)
    got = totals(first)
    assert (got["eligible"], got["processed"], got["failed"], got["metadata_events"]) == (3, 3, 0, 3)
    assert len(sent) == 1
    made = [json.loads(r.value) for r in first.events.collect()]
    assert {e["event_type"] for e in made} == {"NODE_UPSERT", "EDGE_UPSERT", "FILE_METADATA_UPSERT"}
    recorded = kept(first)
    store = str(tmp_path / "graph")
    fold_batch(records_of(first), store, buckets=8)
    fold_batch(records_of(first), store)
    nodes = read_graph(spark, store)["nodes"]
    assert nodes.count() == got["node_events"] and nodes.where("placeholder").count() == 0
    assert read_graph(spark, store)["edges"].count() == got["edge_events"]
    assert read_dead_letters(spark, store).count() == 0

    (tree / "src/main.py").write_text("def run(x):\n    return x\n")
    (tree / ".github/tool.py").write_text("a = (\n")
    second = run(recorded)
    got = totals(second)
    assert (got["processed"], got["skipped_unchanged"], got["failed"], got["error_events"]) == (1, 1, 1, 1)
    summary = {r.file_path: r for r in second.replay.collect()}["src/main.py"]
    assert summary.status == "SUCCESS" and summary.removed_node_count > 0 and summary.removed_edge_count > 0
    deletes = [json.loads(r.value) for r in second.events.where("event_type = 'NODE_DELETE'").collect()]
    assert len(deletes) == summary.removed_node_count
    assert {d["content_hash"] for d in deletes} == {summary.old_content_hash}
    after = kept(second)
    assert after["files"].count() == 3  # the broken file keeps its old state
    assert os.path.exists(tree / "setup.py")


def test_measures_in_chunks(spark, tmp_path, monkeypatch):
    texts = {"a.py": "x\r\ny\r\n", "b.py": "x\r", "c.py": "é\n\x0b\x85  z", "d.py": "", "e.py": "\r\n" * 50 + "end", "f.py": "x = 1\n" * 1_200_000}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "g.py").write_bytes(b"\xff\xfe")
    scanned = scan_files(spark, str(tmp_path))
    rows = {r.file_path: r for r in measure_sources(scanned, str(tmp_path)).collect()}
    for name, text in texts.items():
        assert (rows[name].line_count, rows[name].size_bytes) == (len(text.splitlines()), len(text.encode())), name
        assert rows[name].content_hash == hashlib.sha256(text.encode()).hexdigest()
    assert rows["g.py"].read_error == "g.py: not UTF-8 text" and rows["f.py"].size_bytes > 5 << 20
    limited = {r.file_path: r.read_error for r in read_sources(scanned, str(tmp_path), 1000).collect()}
    assert limited["f.py"] == "f.py: 7200000 bytes, more than the limit of 1000" and limited["a.py"] is None


def test_only_changed_files_are_read_and_texts_stay(spark, tree):
    sources = pipeline.tree_sources(spark, str(tree), "demo", "c1")
    changed = sources.measured.where("file_path = 'src/main.py'").select("file_id", "file_path")
    flat = flatten(sources.read(changed))
    assert {r.file_id for r in flat.select("file_id").distinct().collect()} == {changed.first().file_id}
    plan = flat._jdf.queryExecution().executedPlan().toString()
    above_the_read = plan[: plan.index("MapInPandas")]
    assert "MapInArrow" in above_the_read and "Exchange" not in above_the_read


def test_run_publishes_in_order_and_holds_back_a_bad_file(spark, tree, tmp_path, monkeypatch):
    store, out = str(tmp_path / "state"), str(tmp_path / "topics")
    run = lambda: pipeline.run(pipeline.tree_sources(spark, str(tree), "demo", "c1"), store, lambda e: events.publish(e, "json", out, mode="overwrite"), buckets=8)
    assert run()["processed"] == 3
    assert run()["skipped_unchanged"] == 3
    assert pipeline.read_digests(spark, store).groupBy("version").count().count() == 2

    (tree / "src/main.py").write_text("def run(y):\n    return y\n")
    (tree / ".github/tool.py").write_text("a = 2\nb = a\n")
    real = pipeline.validate.validate_events
    bad = (F.col("file_path") == ".github/tool.py") & (F.col("event_type") == "EDGE_UPSERT")
    monkeypatch.setattr(pipeline.validate, "validate_events", lambda e: real(e.withColumn("file_path", F.get_json_object("value", "$.file_path"))).withColumn("violations", F.when(bad, F.array(F.lit("made up"))).otherwise(F.col("violations"))).drop("file_path"))
    got = run()
    assert (got["processed"], got["failed"], got["error_events"]) == (1, 1, 1)
    for topic in ("cpg.nodes", "cpg.edges"):
        sent = [json.loads(r.value) for r in spark.read.json(f"{out}/topic={topic}").coalesce(1).collect()]
        kinds = [e["event_type"] for e in sent]
        assert {e["file_path"] for e in sent} == {"src/main.py"} and kinds == sorted(kinds) and "DELETE" in kinds[0]
    (error,) = [json.loads(r.value) for r in spark.read.json(f"{out}/topic=parser.errors").collect()]
    assert error["file_path"] == ".github/tool.py" and error["error"]["error_type"] == "ContractError"
    monkeypatch.undo()
    assert run()["processed"] == 1  # what was held back is still to do

    def refuse(_):
        raise OSError("no broker")

    (tree / "src/main.py").write_text("pass\n")
    with pytest.raises(OSError):
        pipeline.run(pipeline.tree_sources(spark, str(tree), "demo", "c1"), store, refuse)
    assert run()["processed"] == 1


def test_a_small_change_shuffles_no_recorded_ids(spark, tmp_path):
    keys = ["file_id", "node_id"]
    spark.range(20_000).selectExpr("cast(id % 100 as string) as file_id", "cast(id as string) as node_id").write.parquet(str(tmp_path / "state"))
    spark.createDataFrame([("1", "1"), ("1", "x")], "file_id string, node_id string").write.parquet(str(tmp_path / "current"))
    recorded, current = spark.read.parquet(str(tmp_path / "state")), spark.read.parquet(str(tmp_path / "current"))
    removed = diff.removed_ids(recorded.unionByName(recorded.limit(5)).where("file_id = '1'"), current, keys)
    assert removed.count() == 199
    plan = diff.removed_ids(recorded, current, keys)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastHashJoin") :]
    assert "hashpartitioning" not in below and "BroadcastExchange" in below


def test_fail_fast_stops_parsing(spark, tmp_path, monkeypatch):
    """An early failure: of 40 files a few are parsed after it, none beyond its range of paths."""
    for i in range(40):
        (tmp_path / f"f{i:02}.py").write_text("x = (\n" if i == 5 else f"x = {i}\n")
    parsed = []
    real = pipeline.flatten

    def counting(sources, **options):
        parsed.extend(r.file_path for r in sources.select("file_path").collect())
        return real(sources, **options)

    monkeypatch.setattr(pipeline, "flatten", counting)
    sources = pipeline.tree_sources(spark, str(tmp_path), "demo", "c1")
    got = totals(pipeline.process(sources, state.empty_state(spark), fail_fast=True))
    assert (got["processed"], got["failed"]) == (5, 1) and len(parsed) == len(set(parsed))
    assert set(parsed) >= {f"f{i:02}.py" for i in range(6)} and len(parsed) <= 12
    (tmp_path / "f03.py").write_bytes(b"\xff")
    parsed.clear()
    got = totals(pipeline.process(pipeline.tree_sources(spark, str(tmp_path), "demo", "c1"), state.empty_state(spark), fail_fast=True))
    assert (got["processed"], got["failed"]) == (3, 1) and max(parsed) == "f02.py"


def test_run_limit(spark, tree):
    got = totals(pipeline.process(pipeline.tree_sources(spark, str(tree), "demo", "c1"), state.empty_state(spark), limit=2))
    assert (got["eligible"], got["processed"]) == (2, 2)


def test_equal_runs_have_equal_digests(spark, tree):
    def digests():
        made = pipeline.process(pipeline.tree_sources(spark, str(tree), "demo", "c1"), state.empty_state(spark))
        return {r.name: (r.rows, r.digest) for r in pipeline._digests(made, 0).collect()}

    one = digests()
    assert one == digests() and set(one) == {"edges", "events", "nodes"} and all(rows for rows, _ in one.values())
    (tree / "src/main.py").write_text("def run(x):\n    return x + 1\n")
    other = digests()
    assert all(one[name] != other[name] for name in one)


def test_work_tables_are_removed(spark, tmp_path):
    with work_tables(spark):
        table = written(spark.range(3), "kept")
        (path,) = {os.path.dirname(f) for f in table.inputFiles()}
        assert table.count() == 3
    assert not os.path.exists(path.removeprefix("file:"))
