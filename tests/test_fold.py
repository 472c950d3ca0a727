"""Graph fold: ordered events -> final tables, and the fold against a one-by-one replay of random histories."""

import json
import random

import pytest
from pyspark.sql import functions as F

from arborflow.operators import endpoints, fold, quality
from arborflow.sources.records import RECORD_SCHEMA

BASE = {
    "schema_version": "1.0", "event_id": "e", "event_time": "2026-01-01T00:00:00Z", "repository_id": "demo",
    "commit_sha": "c", "file_id": "f", "file_path": "f.py", "parser_version": "1.0.0",
}


def node(kind, node_id, content="h1", **fields):
    body = {"node_id": node_id, **fields}
    if kind == "UPSERT":
        body = {"node_type": "Name", "ast_path": "Module", "properties": {}} | body
    return "cpg.nodes", {**BASE, "event_type": f"NODE_{kind}", "content_hash": content, "node": body}


def edge(kind, edge_id, content="h1", source=None, target=None, **fields):
    body = {"edge_id": edge_id, **fields}
    if source:
        body |= {"source_id": source, "target_id": target}
    if kind == "UPSERT":
        body = {"edge_type": "CALLS", "properties": {}} | body
    return "cpg.edges", {**BASE, "event_type": f"EDGE_{kind}", "content_hash": content, "edge": body}


def link(edge_id="e1", content="h1", source="a", target="b", **fields):
    return edge("UPSERT", edge_id, content, source, target, **fields)


def run(spark, graph, events, run_length=fold.RUN_LENGTH):
    """Fold one batch and return the written tables plus dead letters."""
    rows = [
        ("f", json.dumps(body) if isinstance(body, dict) else body, topic, 0, offset, None)
        for offset, (topic, body) in enumerate(events)
    ]
    records = spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1)
    of_topic = lambda topic: records.where(F.col("topic") == topic)
    tables, dead = fold.fold_graph(graph, of_topic("cpg.nodes"), of_topic("cpg.edges"), run_length)
    fresh = {name: [tuple(r) for r in table.collect()] for name, table in tables.items()}
    return fresh, [(r.key, r.reason, r.seq) for r in dead.collect()]


def tables_of(spark, rows):
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in fold.GRAPH_TABLES.items()}


def test_scenarios(spark):
    """Independent histories, one entity set each, folded together in three batches."""
    first = [
        node("UPSERT", "kept", name="one", properties={"x": 1, "name": "fake", "content_hash": "fake"}),
        node("UPSERT", "kept", name="one", properties={"x": 1}),
        node("UPSERT", "stale"), node("UPSERT", "gone"), node("UPSERT", "reborn", properties={"x": 1}),
        node("DELETE", "absent"), ("cpg.nodes", "{broken"), ("cpg.nodes", "{}"),
        link("early", source="early-a", target="early-b"),
        node("UPSERT", "d-a"), node("UPSERT", "d-b"), link("detached", source="d-a", target="d-b"),
        node("UPSERT", "t-a"), node("UPSERT", "t-b"),
        link("removed", source="t-a", target="t-b"), link("renewed", source="t-a", target="t-b"),
        link("survives", source="t-a", target="t-b"), edge("DELETE", "never-seen", "h1"),
        link("foreign", source="t-a", target="t-b"),
    ]
    second = [
        node("UPSERT", "kept", "h2", name="two", properties={"y": True}),
        node("DELETE", "stale", "h0"), node("DELETE", "gone"), node("DELETE", "gone"),
        node("DELETE", "reborn"), node("UPSERT", "reborn", name="new"),
        node("UPSERT", "early-a", name="real"), node("DELETE", "d-a"),
        edge("DELETE", "removed"), edge("DELETE", "removed"), edge("DELETE", "renewed"),
        edge("DELETE", "survives", "h0", "t-a", "t-b"), link("never-seen", source="t-a", target="t-b"),
        link("foreign", "h2", source="t-a", target="other"), link("foreign", "h3", source="t-a", target="t-b"),
    ]
    third = [
        node("DELETE", "gone"), link("detached", source="d-a", target="d-b"),
        link("removed", source="t-a", target="t-b"), link("renewed", "h2", source="t-a", target="t-b"),
        link("never-seen", "h2", source="t-a", target="t-b"),
    ]
    graph, dead = fold.empty_graph(spark), []
    for events in (first, second, third):
        rows, more = run(spark, graph, events)
        dead.append(sorted(more, key=lambda d: d[2]))
        graph = tables_of(spark, rows)
    nodes = {r[0]: dict(zip(graph["nodes"].columns, r)) for r in rows["nodes"]}
    edges = {r[0]: dict(zip(graph["edges"].columns, r)) for r in rows["edges"]}

    assert set(nodes) == {"kept", "stale", "reborn", "early-a", "early-b", "d-b", "t-a", "t-b"}
    assert nodes["kept"]["name"] == "two" and nodes["kept"]["content_hash"] == "h2"
    assert nodes["kept"]["properties"] == {"x": "1", "y": "true"} and nodes["reborn"]["properties"] == {}
    assert not nodes["early-a"]["placeholder"] and nodes["early-a"]["name"] == "real"
    assert nodes["early-b"]["placeholder"] and nodes["early-b"]["file_path"] is None
    assert nodes["early-b"]["repository_id"] == "demo"
    buried = [("d-a", "f:h1:1.0.0:1.0", "f"), ("gone", "f:h1:1.0.0:1.0", "f"), ("reborn", "f:h1:1.0.0:1.0", "f")]
    assert sorted(rows["node_tombstones"]) == buried

    assert {k: v["content_hash"] for k, v in edges.items()} == {
        "early": "h1", "renewed": "h2", "survives": "h1", "never-seen": "h2", "foreign": "h3",
    }
    assert edges["foreign"]["target_id"] == "t-b"
    assert sorted((r[0], r[3]) for r in rows["edge_tombstones"]) == [
        ("never-seen", "h1"), ("removed", "h1"), ("renewed", "h1"), ("survives", "h0"),
    ]
    assert [[d[2] for d in found] for found in dead] == [[6, 7], [13], []]


def replay(events):
    """The rules, one event after the other: nodes first, then edges."""
    nodes, edges, buried, edge_buried, dead = {}, {}, set(), set(), []
    for seq, (topic, body) in sorted(enumerate(events), key=lambda e: (e[1][0] != "cpg.nodes", e[0])):
        generation = body["content_hash"]
        if topic == "cpg.nodes":
            key = body["node"]["node_id"]
            if body["event_type"] == "NODE_UPSERT":
                props = (nodes.get(key) or {"properties": {}})["properties"] | body["node"]["properties"]
                nodes[key] = {"generation": generation, "properties": props, "placeholder": False}
            elif key in nodes and nodes[key]["generation"] == generation:
                del nodes[key]
                buried.add((key, generation))
            continue
        item = body["edge"]
        key, ends = item["edge_id"], (item.get("source_id"), item.get("target_id"))
        alive = edges.get(key)
        if alive and any(e not in (None, a) for e, a in zip(ends, alive["ends"])):
            dead.append(seq)
        elif (ends[0], generation) in buried or (ends[1], generation) in buried:
            pass
        elif body["event_type"] == "EDGE_DELETE":
            edge_buried.add((key, generation))
            if alive and alive["generation"] == generation:
                del edges[key]
        elif (key, generation) not in edge_buried:
            for end in ends:
                nodes.setdefault(end, {"generation": generation, "properties": {}, "placeholder": True})
            props = (alive or {"properties": {}})["properties"] | item["properties"]
            edges[key] = {"ends": ends, "generation": generation, "properties": props}
    return nodes, edges, buried, edge_buried, sorted(dead)


def random_events(pick, pairs):
    """A third of all events hit one entity; a share of the edge events, deletes too, names other endpoints."""
    events = []
    for _ in range(900):
        who = "0" if pick.random() < 0.34 else str(pick.randrange(1, 12))
        content, props = f"h{pick.randrange(5 if pairs == 3 else 60)}", {pick.choice("xyz"): pick.randrange(9)}
        if pick.random() < 0.5:
            kind = "DELETE" if pick.random() < 0.3 else "UPSERT"
            events.append(node(kind, f"n{who}", content, **({"properties": props} if kind == "UPSERT" else {})))
        else:
            ends = (f"n{who}", f"n{pick.randrange(pairs) if pick.random() < (0.1 if pairs == 3 else 0.7) else who}")
            if pick.random() < 0.3:
                named = pick.choice([ends, ends, (ends[0], None), (None, ends[1]), (), (), ()])
                events.append(edge("DELETE", f"e{who}", content, **{k: v for k, v in zip(("source_id", "target_id"), named) if v}))
            else:
                events.append(edge("UPSERT", f"e{who}", content, *ends, properties=props))
    return events


@pytest.mark.parametrize("seed, pairs, short_history, run_length", [(7, 3, 512, 4), (8, 4, 40, 16), (9, 6, 0, 4)])
def test_fold_equals_replay(spark, monkeypatch, seed, pairs, short_history, run_length):
    """Short histories folded in a row, long ones by pointers over runs of four records, or some of both."""
    monkeypatch.setattr(endpoints, "SHORT_HISTORY", short_history)
    events = random_events(random.Random(seed), pairs)
    rows, dead = run(spark, fold.empty_graph(spark), events, run_length)
    nodes, edges, buried, edge_buried, refused = replay(events)
    text = lambda properties: {k: str(v) for k, v in properties.items()}
    hash_at = fold.NODE_TABLE.split(", ").index("content_hash string")
    assert {r[0]: (r[hash_at], r[1], r[-1]) for r in rows["nodes"]} == {
        k: (v["generation"], v["placeholder"], text(v["properties"])) for k, v in nodes.items()
    }
    assert {r[0]: (r[1], r[2], r[8], r[-1]) for r in rows["edges"]} == {
        k: (*v["ends"], v["generation"], text(v["properties"])) for k, v in edges.items()
    }
    assert {(r[0], r[1].split(":")[1]) for r in rows["node_tombstones"]} == buried
    assert {(r[0], r[1].split(":")[1]) for r in rows["edge_tombstones"]} == edge_buried
    assert sorted(d[2] for d in dead) == refused and len(refused) > 10


def test_unique_keys(spark):
    graph = fold.empty_graph(spark)
    quality.assert_unique(graph)
    row = tuple(["a", False] + [None] * 16 + [{}])
    graph["nodes"] = spark.createDataFrame([row, row], fold.NODE_TABLE)
    with pytest.raises(ValueError, match="nodes: duplicate id"):
        quality.assert_unique(graph)
