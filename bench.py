"""Headline queries, timed one by one (the median of their runs); prints one JSON line."""

import json
import os
import time
from statistics import median

from arborflow.plans.queries import QUERIES
from arborflow.session import build_session

HEADLINE = [
    "metadata_latest",
    "manifest_scoped",
    "change_classification",
    "graph_diff_removed",
    "event_records",
    "event_order",
    "validate_node",
    "stream_audit",
    "node_fold",
    "edge_fold",
    "ast_nodes",
    "ast_child_edges",
    "cfg_edges",
    "dfg_edges",
    "call_edges",
    "file_stats",
]


def repeated(run) -> list:
    """Seconds of three runs; of fewer, once they have taken 15 s together."""
    taken: list = []
    while len(taken) < 3 and sum(taken) < 15:
        started = time.perf_counter()
        run()
        taken.append(time.perf_counter() - started)
    return taken


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(median(repeated(lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
