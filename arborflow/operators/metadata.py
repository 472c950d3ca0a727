"""File statistics from metadata events: flatten, keep the newest per file, merge into the table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.constants import ENVELOPE_FIELDS, METADATA_COUNTERS, METADATA_FIELDS
from arborflow.functions.runs import sequence
from arborflow.operators.state import upsert

_STATISTICS = ", ".join(f"{c}: {'bigint' if c in METADATA_COUNTERS else 'string'}" for c in METADATA_FIELDS)
EVENT_SCHEMA = ", ".join(f"{c} string" for c in ENVELOPE_FIELDS) + f", metadata struct<{_STATISTICS}>"
TABLE_FIELDS = [c for c in ENVELOPE_FIELDS if c != "event_type"] + METADATA_FIELDS
TABLE_SCHEMA = ", ".join(f"{c} {'bigint' if c in METADATA_COUNTERS else 'string'}" for c in TABLE_FIELDS)


def metadata_events(records: DataFrame, keep=()) -> DataFrame:
    """The 19 columns of each FILE_METADATA_UPSERT record, and the record's own columns named in `keep`.

    Malformed JSON parses to a struct of nulls, which the event type test drops.
    """
    parsed = records.select(*keep, F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event"))
    wanted = parsed.where(F.col("event.event_type") == "FILE_METADATA_UPSERT")
    envelope = [F.col(f"event.{c}").alias(c) for c in TABLE_FIELDS if c not in METADATA_FIELDS]
    return wanted.select(*keep, *envelope, *[F.col(f"event.metadata.{c}").alias(c) for c in METADATA_FIELDS])


def latest_by_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key by a number. The narrow maximum comes first, so of wide rows only the last ones move
    (Spark broadcasts the maxima while they are few); a row that came twice counts once."""
    numbered = rows.withColumn("_at", order)
    last = numbered.groupBy(key).agg(F.max("_at").alias("_at"))
    return numbered.join(last, [key, "_at"]).dropDuplicates([key]).select(rows.columns)


def merge_metadata(table: DataFrame, records: DataFrame) -> DataFrame:
    """Table after the records: one row per file, replaced whole by its newest event."""
    fresh = metadata_events(records, keep=("partition", "offset"))
    newest = latest_by_key(fresh, "file_id", sequence(F.col("partition"), F.col("offset"))).select(TABLE_FIELDS)
    return upsert(table, newest)
