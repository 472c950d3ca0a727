"""Working tree -> validated, ordered events and the next state, as one incremental run."""

from collections import namedtuple
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.constants import SCOPES
from arborflow.operators import calls, diff, events, graph, manifest, state, validate
from arborflow.operators.flatten import flatten, parse_errors
from arborflow.session import work_tables, written
from arborflow.sources.files import check_sources, identify, measure_sources, read_sources, scan_files
from arborflow.sources.buckets import BUCKETS, Change, Store, touched_buckets

Run = namedtuple("Run", "results events state summary replay")
_MEASURED = ("size_bytes", "line_count")
TO_PARSE = ("NEW", "CHANGED", "VERSION_REFRESH")
WAVES = 16  # ranges of paths that a run with fail_fast parses one after the other
DIGESTS = "version bigint, name string, rows bigint, digest string"


class Sources(NamedTuple):
    """Narrow rows of the files in scope, and how to read the contents of some of them.

    measured: file_id, file_path, repository_id, commit_sha, content_hash, size_bytes, line_count, read_error.
    read: rows with file_id, file_path and content of the given (file_id, file_path) rows; content is NULL where
    the file cannot be read any more.
    """

    measured: DataFrame
    read: Callable[[DataFrame], DataFrame]


def discover(spark: SparkSession, root: str, repository_id: str, commit_sha: str, scope="final", source_root=None, scopes=SCOPES):
    """Manifest of a working tree. Files are hashed in chunks, contents are not kept."""
    files = measure_sources(scan_files(spark, root, source_root), root)
    hashed = files.select("file_path", "size_bytes", F.col("content_hash").alias("content_sha256"))
    return manifest.build_manifest(hashed, repository_id, commit_sha, scope, scopes)


def tree_sources(
    spark: SparkSession, root: str, repository_id: str, commit_sha: str, scope="final", source_root=None, scopes=SCOPES, max_bytes=None
) -> Sources:
    """Files of a working tree in scope, ready for `process`. Files above max_bytes, if it is given, fail."""
    files = manifest.selected_files(scan_files(spark, root, source_root), manifest.resolved(scope, scopes))
    return Sources(_stamped(measure_sources(files, root, max_bytes), repository_id, commit_sha), lambda wanted: read_sources(wanted, root, max_bytes))


def table_sources(sources: DataFrame, repository_id: str, commit_sha: str, max_bytes=None) -> Sources:
    """The same from a table with file_path and content, which is what a very large code base is read from.

    Spark broadcasts the wanted paths while they are few; when most files changed, their contents are shuffled once.
    """
    checked = _stamped(check_sources(sources, max_bytes), repository_id, commit_sha)
    measured = checked.select(*[c for c in checked.columns if c not in ("content", *_MEASURED)], *graph.measures())
    contents = checked.select("file_path", "content")
    return Sources(measured, lambda wanted: contents.join(wanted, "file_path"))


def _stamped(sources, repository_id, commit_sha):
    stamps = {"repository_id": F.lit(repository_id), "commit_sha": F.lit(commit_sha)}
    return identify(sources.withColumns(stamps), repository_id)


def _parsed_in_waves(sources: Sources, changed: DataFrame, unread: DataFrame) -> DataFrame:
    """Flattened rows of the changed files, by ranges of paths one after the other, until one of them has a failure.

    Files beyond the first that could not be read are not parsed at all, nor are those of ranges after a failing one.
    """
    first = unread.agg(F.min("file_path")).first()[0]
    if first is not None:
        changed = changed.where(F.col("file_path") < first)
    ranged = changed.select("file_id", "file_path").repartitionByRange(WAVES, "file_path").withColumn("wave", F.spark_partition_id())
    ranged = written(ranged, "waves")
    flat = None
    for wave in range(WAVES):
        files = ranged.where(F.col("wave") == wave).drop("wave")
        if wave and files.isEmpty():
            continue
        rows = written(flatten(sources.read(files), counted=True), "flat")
        flat = rows if flat is None else flat.unionByName(rows)
        if not parse_errors(rows).isEmpty():
            break
    return flat


def process(sources: Sources, previous: dict[str, DataFrame], publish=None, limit=None, fail_fast=False, only=None, when=None, narrowed=None) -> Run:
    """Parse what changed, publish its events, return the next state.

    `publish` gets the events of the run; an exception in it leaves the state as it was. A file with an event that
    breaks its contract sends an error event instead of all its events. Failed files keep their old state and graph. With fail_fast, files after the first failed
    one (by path) are left for the next run. `narrowed` gives, for the rows to parse, the part of `previous` that holds
    them; the state of the run is then that part's.
    """
    files = sources.measured
    if only is not None:
        files = files.where(F.col("file_path") == only)
    discovered = None
    if limit:
        discovered = files.count()
        files = files.join(files.select("file_path").orderBy("file_path").limit(limit), "file_path", "left_semi")

    # Narrow rows decide what to parse; only the files that changed are read.
    classified = written(diff.classify(files, previous["files"]), "classified")
    changed = classified.where(F.col("change").isin(*TO_PARSE))
    unread = classified.where("change = 'FAILED'").withColumn("message", F.col("read_error")).withColumn("error_type", F.lit("ReadFileError"))
    flat = _parsed_in_waves(sources, changed, unread) if fail_fast else written(flatten(sources.read(changed.select("file_id", "file_path")), counted=True), "flat")
    failures = parse_errors(flat)
    syntax = classified.join(failures, "file_id").withColumn("error_type", F.substring_index("message", " in ", 1))
    failed = unread.unionByName(syntax)
    if fail_fast:
        first = failed.agg(F.min("file_path")).first()[0]
        if first is not None:
            up_to = F.col("file_path") <= first
            classified, changed, failed = classified.where(up_to), changed.where(up_to), failed.where(up_to)
    if narrowed is not None:
        previous = narrowed(changed)
    parsed = changed.join(failures.select("file_id"), "file_id", "left_anti")
    wanted = lambda rows: rows.join(parsed.select("file_id"), "file_id", "left_semi")

    rows = wanted(flat)
    resolved = written(calls.resolve_calls(rows), "calls")
    nodes, edges = written(graph.graph_nodes(rows, resolved), "nodes"), written(graph.graph_edges(rows, resolved), "edges")
    stats = graph.file_stats(parsed, rows, resolved)
    gone_nodes = diff.removed_ids(wanted(previous["nodes"]), nodes, ["file_id", "node_id"])
    gone_edges = diff.removed_ids(wanted(previous["edges"]), edges, ["file_id", "edge_id"])
    about = parsed.select("file_id", "repository_id", "commit_sha", "file_path", "content_hash", "previous_hash")
    made_events = events.build_events(about, nodes, edges, stats, gone_nodes, gone_edges, when)
    made_events = made_events.unionByName(events.error_events(failed, when))
    # A file goes out whole or not at all: one invalid event holds back the others of its file.
    gated = written(events.publish_gate(validate.validate_events(made_events)), "events")
    reason = F.concat_ws(": ", "event_type", F.array_join("violations", ", "))
    held = gated.where(F.size("violations") > 0).groupBy("file_id").agg(F.min(reason).alias("message"))
    held = written(held.withColumn("message", F.concat(F.lit("ContractError in "), "message")), "held")
    withheld = classified.join(held, "file_id").withColumn("error_type", F.lit("ContractError"))
    outgoing = gated.where("publishable").drop("violations", "publishable").unionByName(events.error_events(withheld, when))
    if publish is not None:
        publish(outgoing)
    about = about.join(held, "file_id", "left_anti")
    failures = failures.unionByName(held.select("file_id", "message"))

    results = events.file_results(classified, outgoing, failures)
    replay = diff.replay_summary(classified, gone_nodes, gone_edges, nodes, edges, failures)
    following = state.commit_state(previous, about, nodes, edges)
    return Run(results, outgoing, following, events.run_summary(results, discovered), replay)


def _digests(made: Run, version: int) -> DataFrame:
    """Digests of what a run sent and kept, without times: equal for equal runs, see manifest.run_difference."""
    tables = {"events": made.events.select("topic", "key", "event_type", "event_id"), "nodes": made.state["nodes"], "edges": made.state["edges"]}
    rows = None
    for name, table in tables.items():
        row = manifest.multiset_digest(table).select(F.lit(version).cast("bigint").alias("version"), F.lit(name).alias("name"), "rows", "digest")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def read_digests(spark: SparkSession, store: str) -> DataFrame:
    """Version, table, number of rows and digest of each recorded run."""
    return spark.read.schema(DIGESTS).parquet(f"{store}/digests")


def run(sources: Sources, store: str, publish, buckets: int = BUCKETS, **options) -> dict:
    """process() on the state at `store`: publish first, then record the new state of the files that changed.

    When publishing fails nothing is recorded, and the next run sends the same events under the same ids again. Of
    the recorded ids only the buckets of files to parse are read, and only those are rewritten.
    """
    spark = sources.measured.sparkSession
    kept = Store(spark, store, state.STATE_TABLES, {name: "file_id" for name in state.STATE_TABLES}, buckets)
    touched: list = []

    def narrowed(changed):
        touched.extend(touched_buckets(changed.select("file_id"), kept.buckets))
        return kept.read({name: touched for name in state.STATE_TABLES})

    with work_tables(spark):
        made = process(sources, kept.read(), publish, narrowed=narrowed, **options)
        told = _digests(made, 0 if kept.version is None else kept.version + 1).collect()  # three rows
        kept.commit({name: Change(rows, "file_id", touched) for name, rows in made.state.items()})
        spark.createDataFrame(told, DIGESTS).coalesce(1).write.mode("append").parquet(f"{store}/digests")
        return made.summary.first().asDict()
