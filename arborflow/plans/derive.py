"""Inputs of the registered queries, derived from the given tables row by row."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.functions import ids

REPOSITORY = "docs"
COMMIT = "c0ffee"

# Python statements a document line becomes, by its length modulo 5. {line} is the whole line as a literal.
HEADER = "import json as tool\nfrom . import base\nsize = {size}\ntotal = size\n"
STATEMENTS = [
    'note = part("{line}")',
    'if size:\n    size = "{line}"\nelse:\n    size = None',
    'for piece in size:\n    if piece:\n        continue\n    total = "{line}"',
    'total = tool.clean(total, "{line}")',
    'def part(text, width):\n    while text:\n        text = width\n        break\n    width = "{line}"\n    return base.make(text)',
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A table over all cores; one whose files, or else their row groups, reach all of them stays where it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if len(rows.inputFiles()) >= cores:
        return rows
    tasks = rows.select(F.spark_partition_id().alias("task"))  # no column is read, only the files' row counts
    reached = tasks.rdd.getNumPartitions() >= cores and tasks.distinct().count() >= cores
    return rows if reached else rows.repartition(cores)


def document_files(spark, sf) -> DataFrame:
    """documents as source files spread over test, generated and main folders."""
    folder = F.when(F.col("lang") == "de", "tests").when(F.col("lang") == "es", "generated").otherwise("main")
    prefix = F.when(F.col("source") == "src1", "test_").when(F.col("source") == "src2", "setup_").otherwise("")
    path = F.concat_ws("/", "source", folder, F.concat(prefix, F.col("doc_id"), F.lit(".py")))
    return table(spark, sf, "documents").withColumn("file_path", path)


def manifest_input(spark, sf) -> DataFrame:
    return document_files(spark, sf).select(
        "file_path",
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        ids.content_hash(F.col("text")).alias("content_sha256"),
    )


def document_sources(spark, sf, broken=False) -> DataFrame:
    """Each document's whole text as a Python file, one statement per line; with `broken`, those in Spanish do not parse."""
    def escaped(line):
        for plain, told in (("\\", "\\\\"), ('"', '\\"'), ("\r", "\\r")):
            line = F.replace(line, F.lit(plain), F.lit(told))
        return line

    def statement(line):
        kinds = [F.replace(F.lit(s), F.lit("{line}"), escaped(line)) for s in STATEMENTS]
        chosen = F.when(F.length(line) % 5 == 0, kinds[0])
        for kind in range(1, 5):
            chosen = chosen.when(F.length(line) % 5 == kind, kinds[kind])
        return chosen

    body = F.array_join(F.transform(F.split("text", "\n"), statement), "\n")
    header = F.replace(F.lit(HEADER), F.lit("{size}"), F.col("n_chars").cast("string"))
    unclosed = F.when((F.col("lang") == "es") & F.lit(broken), "\nprint(").otherwise("\n")
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id"), F.lit(".py")))
    return table(spark, sf, "documents").select(
        F.lit(REPOSITORY).alias("repository_id"),
        path.alias("file_path"),
        ids.file_id(REPOSITORY, path).alias("file_id"),
        F.encode(F.concat(header, body, unclosed), "UTF-8").alias("content"),
    )


def document_state(spark, sf) -> DataFrame:
    """Labelled documents as recorded state: toxic ones had another text, the rest partly other versions."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id"), F.lit(".py")))
    return labelled.select(
        ids.file_id(REPOSITORY, path).alias("file_id"),
        F.sha2(F.concat("text", F.when(F.col("toxic") == 1, "!").otherwise("")), 256).alias("content_hash"),
        F.when(F.col("quality") == 1, "1.0.0").alias("parser_version"),
        F.when(F.col("lang") == "fr", "0.9").otherwise("1.0").alias("schema_version"),
    )


def document_versions(spark, sf) -> DataFrame:
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id"), F.lit(".py")))
    return table(spark, sf, "documents").select(
        ids.file_id(REPOSITORY, path).alias("file_id"),
        path.alias("file_path"),
        F.sha2("text", 256).alias("content_hash"),
        F.when(F.col("lang") == "es", "unreadable").alias("read_error"),
    )


def event_columns(spark, sf) -> DataFrame:
    """events with the number in props and a content version h."""
    return spread(table(spark, sf, "events")).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.concat(F.lit("c"), F.floor(F.col("value") / 100).cast("string")).alias("h"),
    )


def _record(events: DataFrame, topic: str, value) -> DataFrame:
    return events.select(
        F.concat(F.lit("f"), "user_id").alias("key"),
        F.to_json(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _envelope(kind) -> list:
    return [
        kind.alias("event_type"),
        F.lit(REPOSITORY).alias("repository_id"),
        F.concat(F.lit("f"), "user_id").alias("file_id"),
        F.lit("1.0.0").alias("parser_version"),
        F.lit("1.0").alias("schema_version"),
        F.col("h").alias("content_hash"),
    ]


def node_records(spark, sf) -> DataFrame:
    """One node per user; a purchase deletes it, anything else upserts it with one property."""
    gone = F.col("event_type") == "purchase"
    node = F.struct(
        F.concat(F.lit("n"), "user_id").alias("node_id"),
        F.when(~gone, F.col("event_type")).alias("name"),
        F.when(~gone, F.create_map(F.concat(F.lit("p_"), "event_type"), F.col("k"))).alias("properties"),
    )
    kind = F.when(gone, "NODE_DELETE").otherwise("NODE_UPSERT")
    return _record(event_columns(spark, sf), "cpg.nodes", F.struct(*_envelope(kind), node.alias("node")))


def faulty_node_records(spark, sf) -> DataFrame:
    """The same, some of them broken: k < 5 no JSON, k < 10 no event, k < 20 an upsert without an id."""
    rows = node_records(spark, sf)
    k = F.pmod(F.col("offset"), F.lit(100))
    unnamed = F.regexp_replace("value", '"node_id":"[^"]*",?', "")
    value = F.when(k < 5, F.substr("value", F.lit(2))).when(k < 10, "{}").when(k < 20, unnamed).otherwise(F.col("value"))
    return rows.withColumn("value", value)


def edge_records(spark, sf) -> DataFrame:
    """One edge per user, from its node to one named after the event type; a signup deletes it."""
    gone = F.col("event_type") == "signup"
    edge = F.struct(
        F.concat(F.lit("e"), "user_id").alias("edge_id"),
        F.when(~gone, F.concat(F.lit("n"), "user_id")).alias("source_id"),
        F.when(~gone, F.concat(F.lit("t-"), "event_type")).alias("target_id"),
        F.when(~gone, F.lit("CALLS")).alias("edge_type"),
    )
    kind = F.when(gone, "EDGE_DELETE").otherwise("EDGE_UPSERT")
    return _record(event_columns(spark, sf), "cpg.edges", F.struct(*_envelope(kind), edge.alias("edge")))


def metadata_records(spark, sf) -> DataFrame:
    """Statistics events, one file per user; errors carry another event type, clicks are broken JSON."""
    kind = F.when(F.col("event_type") == "error", "PARSER_ERROR").otherwise("FILE_METADATA_UPSERT")
    metadata = F.struct(
        F.col("k").alias("size_bytes"),
        *[F.lit(n).alias(c) for n, c in enumerate(("line_count", "function_count", "class_count", "import_count", "node_count", "edge_count", "parse_duration_ms"))],
        F.col("event_type").alias("parse_status"),
        F.lit("python.ast").alias("parser"),
    )
    body = F.struct(
        *_envelope(kind),
        F.concat(F.lit("x"), "event_id").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        F.lit(COMMIT).alias("commit_sha"),
        F.concat(F.lit("u/"), "user_id", F.lit(".py")).alias("file_path"),
        metadata.alias("metadata"),
    )
    records = _record(event_columns(spark, sf), "source.metadata", body)
    broken = F.get_json_object("value", "$.metadata.parse_status") == "click"
    return records.withColumn("value", F.when(broken, F.lit("{broken")).otherwise(F.col("value")))


#: kinds of record that events of a type stand for
CONTRACT_KINDS = {
    "view": ("NODE_UPSERT", "NODE_DELETE"),
    "click": ("EDGE_UPSERT", "EDGE_DELETE"),
    "signup": ("FILE_METADATA_UPSERT",),
    "error": ("PARSER_ERROR",),
    "purchase": ("NODE_UPSERT", "EDGE_DELETE"),
}


def contract_records(spark, sf, event_type: str, upsert: str, delete: str | None = None) -> DataFrame:
    """Events of one topic built as text, broken in ways that depend on k.

    k < 10: no event_id; < 20: other schema_version; < 30: extra key; < 40: wrong type in the payload;
    < 50: required payload field missing; < 55: unknown type; < 60: not JSON; < 65: payload is no object;
    < 70: a number that is not finite.
    """
    k = F.col("k")
    payloads = {
        "NODE_UPSERT": ("node", '"node_id":"n","ast_path":"Module","line_start":1.0,"name":null,"properties":{"a":1}', '"node_type":"Name"', '"node_type":5'),
        "NODE_DELETE": ("node", "", '"node_id":"n"', '"node_id":null'),
        "EDGE_UPSERT": ("edge", '"edge_id":"e","source_id":"a","target_id":"b","properties":{}', '"edge_type":"CALLS"', '"edge_type":{}'),
        "EDGE_DELETE": ("edge", "", '"edge_id":"e"', '"edge_id":true'),
        "FILE_METADATA_UPSERT": (
            "metadata",
            '"line_count":1,"function_count":2,"class_count":3,"import_count":4,"node_count":5,"edge_count":6,"parse_duration_ms":7,"parse_status":"SUCCESS","parser":"p"',
            '"size_bytes":10',
            '"size_bytes":"10"',
        ),
        "PARSER_ERROR": ("error", '"error_type":"SyntaxError","message":"m","line":null,"column":3', '"retryable":false', '"retryable":"no"'),
    }

    def text(kind):
        name, base, good, bad = payloads[kind]
        comma = "," if base else ""
        field = F.when((k >= 30) & (k < 40), comma + bad).when((k >= 40) & (k < 50), "").otherwise(comma + good)
        body = F.when((k >= 60) & (k < 65), F.lit(f'"{name}":"flat"')).otherwise(F.concat(F.lit(f'"{name}":{{{base}'), field, F.lit("}")))
        body = F.when((k >= 65) & (k < 70), F.lit(f'"{name}":{{"x":-Infinity}}')).otherwise(body)
        return F.concat(
            F.lit('{"event_time":"t","repository_id":"r","commit_sha":"c","file_path":"p","content_hash":"h","parser_version":"1.0.0","file_id":"f"'),
            F.when(k >= 10, F.concat(F.lit(',"event_id":"'), "event_id", F.lit('"'))).otherwise(""),
            F.when((k >= 10) & (k < 20), ',"schema_version":"2.0"').otherwise(',"schema_version":"1.0"'),
            F.when((k >= 20) & (k < 30), ',"source_path":"s"').otherwise(""),
            F.when((k >= 50) & (k < 55), ',"event_type":"NODE_PATCH",').otherwise(f',"event_type":"{kind}",'),
            body,
            F.when((k >= 55) & (k < 60), "").otherwise("}"),
        )

    rows = event_columns(spark, sf).where(F.col("event_type") == event_type)
    value = text(upsert) if delete is None else F.when(F.col("value") < 50, text(delete)).otherwise(text(upsert))
    return rows.select("event_id", value.alias("value"))


def audit_records(spark, sf) -> DataFrame:
    """Delete events with repeated event ids, some foreign keys and some contract breaks."""
    topic = F.when(F.col("event_type").isin("view", "click"), "cpg.nodes").otherwise("cpg.edges")
    payload = F.when(topic == "cpg.nodes", ',"event_type":"NODE_DELETE","node":{"node_id":"n"}').otherwise(',"event_type":"EDGE_DELETE","edge":{"edge_id":"e"}')
    file_id = F.concat(F.lit("f"), "user_id")
    value = F.concat(
        F.lit('{"event_time":"t","repository_id":"r","commit_sha":"c","file_path":"p","content_hash":"h","parser_version":"1.0.0","schema_version":"1.0","file_id":"'),
        file_id,
        F.lit('"'),
        F.when(F.col("event_type") == "signup", "").otherwise(F.concat(F.lit(',"event_id":"'), "user_id", F.lit("-"), "k", F.lit('"'))),
        payload,
        F.lit("}"),
    )
    return event_columns(spark, sf).select(
        F.when((F.col("event_type") == "click") & (F.col("k") < 50), "other").otherwise(file_id).alias("key"),
        value.alias("value"),
        topic.alias("topic"),
        F.when(F.col("value") < 200, 0).otherwise(1).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def graph_tables(spark, sf) -> dict:
    """lineitem, customer and orders read as graph tables."""
    flag = F.col("l_returnflag")
    nodes = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(flag != "N", F.col("l_suppkey").cast("string")).alias("file_id"),
        F.when(F.col("l_linestatus") == "O", F.concat_ws(":", "l_suppkey", "l_returnflag")).alias("generation_id"),
        ((flag == "R") & (F.col("l_quantity") > 40)).alias("placeholder"),
    )
    edges = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("edge_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("file_id"),
        F.when(F.col("o_totalprice") > 1000, F.concat_ws(":", "o_custkey", "o_orderpriority")).alias("generation_id"),
        F.col("o_orderpriority").alias("edge_type"),
    )
    return {"nodes": nodes, "edges": edges}
