"""Metadata topic -> one statistics row per file."""

from pyspark.sql import DataFrame, SparkSession

from arborflow.operators.metadata import TABLE_SCHEMA, merge_metadata, metadata_events
from arborflow.session import work_tables, written
from arborflow.sources.buckets import BUCKETS, Change, Store, touched_buckets


def with_trigger(writer, processing_time=None, available_now=False):
    """At most one trigger; none means micro-batches as fast as they come."""
    if processing_time and available_now:
        raise ValueError("processing_time and available_now cannot be used together")
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer.trigger(availableNow=True) if available_now else writer


def mongodb_writer(records: DataFrame, checkpoint: str, uri: str, database: str, collection: str, **trigger):
    """Append stream into a document store through its Spark connector: replace by file_id, insert if absent."""
    writer = metadata_events(records).writeStream.format("mongodb").outputMode("append")
    options = {
        "checkpointLocation": checkpoint,
        "spark.mongodb.connection.uri": uri,
        "spark.mongodb.database": database,
        "spark.mongodb.collection": collection,
        "spark.mongodb.operationType": "replace",
        "spark.mongodb.idFieldList": "file_id",
        "spark.mongodb.upsertDocument": "true",
    }
    return with_trigger(writer.options(**options), **trigger)


def _store(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Store:
    return Store(spark, path, {"files": TABLE_SCHEMA}, {"files": "file_id"}, buckets)


def merge_batch(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Merge the records that the table does not have yet by file_id; only the buckets of their files are rewritten."""
    spark = records.sparkSession
    store = _store(spark, path, buckets)
    with work_tables(spark):
        fresh = written(store.new_records(records), "metadata-records")
        touched = touched_buckets(metadata_events(fresh).select("file_id"), store.buckets)
        rows = merge_metadata(store.read({"files": touched})["files"], fresh)
        store.commit({"files": Change(rows, "file_id", touched)}, fresh)


def table_writer(records: DataFrame, checkpoint: str, path: str, buckets: int = BUCKETS, **trigger):
    """The same into a table in hash buckets: each micro-batch is merged by file_id."""
    writer = records.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return with_trigger(writer.foreachBatch(lambda batch, _: merge_batch(batch, path, buckets)), **trigger)


def read_metadata(spark, path: str) -> DataFrame:
    return _store(spark, path).read()["files"]
