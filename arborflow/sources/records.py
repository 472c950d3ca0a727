"""Keyed stream records: Kafka where the connector is present, any file format elsewhere."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
OFFSET_SCHEMA = "topic string, partition int, start_offset bigint, end_offset bigint"


def as_text(records: DataFrame) -> DataFrame:
    """Kafka delivers binary key and value; file formats deliver text. Both leave as text."""
    return records.withColumn("key", F.col("key").cast("string")).withColumn("value", F.col("value").cast("string"))


def read_records(spark: SparkSession, source_format="kafka", path=None, **options) -> DataFrame:
    """Bounded read. Kafka takes its startingOffsets/endingOffsets through options."""
    reader = spark.read.format(source_format).options(**options)
    if source_format != "kafka":
        reader = reader.schema(RECORD_SCHEMA)
    return as_text(reader.load(path) if path else reader.load())


def stream_records(spark: SparkSession, source_format="kafka", path=None, starting_offsets="earliest", **options):
    """Unbounded read; starting_offsets counts only while no checkpoint exists."""
    reader = spark.readStream.format(source_format).options(**options)
    if source_format == "kafka":
        reader = reader.option("startingOffsets", starting_offsets)
    else:
        reader = reader.schema(RECORD_SCHEMA)
    return as_text(reader.load(path) if path else reader.load())


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """Manifest or event files, one JSON document per line, with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def offset_window(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """Records inside [start_offset, end_offset) of their topic partition.

    A partition without a start row is outside the window; one without an end offset is read to its end.
    `offsets` has one row per topic partition, so Spark may broadcast it by its own size check.
    """
    bounds = offsets.select("topic", "partition", "start_offset", "end_offset")
    inside = (F.col("offset") >= F.coalesce("start_offset", F.lit(0))) & (
        F.col("end_offset").isNull() | (F.col("offset") < F.col("end_offset"))
    )
    return records.join(bounds, ["topic", "partition"]).where(inside).drop("start_offset", "end_offset")
