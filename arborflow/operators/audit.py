"""Audits over keyed stream records: contract, keys, routing, duplicates, order and lag."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.operators.manifest import RUN_LENGTH, out_of_order
from arborflow.operators.validate import CONTRACTS, violations
from arborflow.session import written
from arborflow.sources.records import offset_window


def audited(records: DataFrame, expected_file_id=None, expected_error_file_id=None) -> DataFrame:
    """Per record: the three ids read from the event, and flags for what is wrong with it."""
    document = F.col("_document")
    rows = records.withColumn("_document", F.try_parse_json("value"))  # the one time the text is parsed
    rows = rows.withColumn("violations", violations(F.col("value"), document)).withColumns(
        {name: F.try_variant_get(document, f"$.{name}", "string") for name in ("event_type", "file_id", "event_id")}
    )
    known = F.col("event_type").isin(*CONTRACTS)
    is_error = F.coalesce(F.col("event_type") == "PARSER_ERROR", F.lit(False))
    expected = F.when(is_error, F.lit(expected_error_file_id)).otherwise(F.lit(expected_file_id))
    return rows.select(
        "topic",
        "partition",
        "offset",
        "event_type",
        "file_id",
        "event_id",
        # An unknown event type is only a warning in this audit.
        (F.coalesce(known, F.lit(False)) & (F.size("violations") > 0)).alias("schema_failure"),
        (~F.col("key").eqNullSafe(F.col("file_id"))).alias("key_mismatch"),
        (expected.isNotNull() & ~F.col("file_id").eqNullSafe(expected)).alias("unexpected_file_id"),
    )


def audit_stream(records: DataFrame, offsets=None, expected_file_id=None, expected_error_file_id=None) -> DataFrame:
    """One row per topic, and one for all of them (topic NULL) with the duplicate event ids.

    Records are parsed once and combined map-side per topic and event id; every count is taken from those rows,
    which are written. An id is empty or absent in malformed events; those are never duplicates.
    """
    records = records if offsets is None else offset_window(records, offsets)
    flags = ["schema_failure", "key_mismatch", "unexpected_file_id"]
    rows = audited(records, expected_file_id, expected_error_file_id)
    per_id = rows.groupBy("topic", "event_id").agg(F.count("*").alias("n"), *[F.count_if(f).alias(f) for f in flags])
    per_id = written(per_id, "audit-ids")
    counts = [F.sum("n").alias("events"), *[F.sum(flag).alias(f"{flag}s") for flag in flags]]
    per_topic = per_id.groupBy("topic").agg(*counts).withColumn("duplicate_event_ids", F.lit(None).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    again = per_id.where("event_id <> ''").groupBy("event_id").agg((F.sum("n") - 1).alias("repeats"))
    both = per_id.select("n", *flags, zero.alias("repeats")).unionByName(again.select(*[zero.alias(c) for c in ("n", *flags)], "repeats"))
    whole = both.agg(*counts, F.sum("repeats").alias("duplicate_event_ids"))
    return per_topic.unionByName(whole.withColumn("topic", F.lit(None).cast("string")).select(per_topic.columns))


def partition_consistency(records: DataFrame, file_id: Column | None = None) -> DataFrame:
    """(topic, file) pairs found on more than one partition."""
    key = F.col("key") if file_id is None else file_id
    return (
        records.where(key.isNotNull() & (key != ""))
        .groupBy("topic", key.alias("file_id"))
        .agg(F.count_distinct("partition").alias("partitions"))
        .where("partitions > 1")
    )


def offset_order(records: DataFrame, position: Column, keys=("topic", "partition", "key"), run_length=RUN_LENGTH):
    """Per key: how often an offset is not above the one before it in `position` order."""
    return out_of_order(records, F.col("offset"), position, keys, run_length)


def offset_delta(before: DataFrame, after: DataFrame, keys=("topic", "partition")) -> DataFrame:
    """Records added per topic between two offset snapshots; a missing partition counts from 0, shrinking as 0."""
    keys = list(keys)
    old = before.select(*keys, F.col("offset").alias("_old"))
    new = after.select(*keys, F.col("offset").alias("_new"))
    grown = F.greatest(F.lit(0), F.coalesce("_new", F.lit(0)) - F.coalesce("_old", F.lit(0)))
    return old.join(new, keys, "full").groupBy("topic").agg(F.sum(grown).alias("delta"))


def lag(end: DataFrame, committed: DataFrame, keys=("topic", "partition")) -> DataFrame:
    """Records not yet consumed per topic."""
    return offset_delta(committed, end, keys).withColumnRenamed("delta", "lag")
