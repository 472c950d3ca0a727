"""Node and edge topics -> graph tables, micro-batch by micro-batch.

The topics are not ordered against each other, so a batch takes its nodes first and edges make placeholders. Progress
is kept with the tables, by topic, partition and offset: what a batch number says does not matter.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.operators import fold
from arborflow.operators.quality import assert_unique
from arborflow.session import work_tables
from arborflow.sources.buckets import BUCKETS, Change, Store, touched_buckets
from arborflow.streaming.metadata import with_trigger

KEYS = {"nodes": "id", "edges": "edge_id", "node_tombstones": "id", "edge_tombstones": "id"}


def _store(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Store:
    return Store(spark, path, fold.GRAPH_TABLES, KEYS, buckets)


def fold_batch(records: DataFrame, path: str, check_keys=False, buckets: int = BUCKETS) -> None:
    """Fold the records that the tables at `path` do not have yet; only the buckets of touched keys are read and rewritten."""
    spark = records.sparkSession
    store = _store(spark, path, buckets)
    with work_tables(spark):
        fresh = store.new_records(records)
        of_topic = lambda topic: fresh.where(F.col("topic") == topic)
        nodes, edges = fold.node_events(of_topic("cpg.nodes")), fold.edge_events(of_topic("cpg.edges"))
        keys = fold.touched_keys(store.read()["edges"], nodes[0], edges[0])
        touched = {name: touched_buckets(rows, store.buckets) for name, rows in keys.items()}
        tables, dead = fold.fold_events(store.read(touched), nodes, edges)
        if check_keys:
            assert_unique(tables)
        version = 0 if store.version is None else store.version + 1
        dead.write.mode("overwrite").parquet(f"{path}/dead_letters/version={version}")
        store.commit({name: Change(rows, KEYS[name], touched[name]) for name, rows in tables.items()}, fresh)


def graph_writer(records: DataFrame, checkpoint: str, path: str, check_keys=False, buckets: int = BUCKETS, **trigger):
    writer = (
        records.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(lambda batch, _: fold_batch(batch, path, check_keys, buckets))
    )
    return with_trigger(writer, **trigger)


def read_graph(spark, path: str) -> dict[str, DataFrame]:
    return _store(spark, path).read()


def read_dead_letters(spark, path: str) -> DataFrame:
    """Dead letters of all committed batches, as connector.errors rows."""
    rows = spark.read.schema(f"{fold.DEAD_LETTER_TABLE}, version bigint").parquet(f"{path}/dead_letters")
    return rows.where(F.col("version") <= _store(spark, path).version).drop("version")
