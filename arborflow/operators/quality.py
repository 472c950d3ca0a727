"""Integrity queries over the graph tables, whole or for one file."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def of_file(table: DataFrame, file_id=None) -> DataFrame:
    return table if file_id is None else table.where(F.col("file_id") == file_id)


def graph_counts(nodes: DataFrame, edges: DataFrame, file_id) -> DataFrame:
    """One row: node and edge count of one file, one aggregate over both filtered scans."""
    kinds = [of_file(part, file_id).select(F.lit(kind).alias("kind")) for part, kind in ((nodes, "node"), (edges, "edge"))]
    return kinds[0].union(kinds[1]).agg(*[F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in ("node", "edge")])


def counts_by_file(table: DataFrame, name: str) -> DataFrame:
    return table.groupBy("file_id").agg(F.count("*").alias(name))


def top_files(table: DataFrame, name: str, n=10) -> DataFrame:
    """The n files with most rows; ties by file_id."""
    return counts_by_file(table, name).orderBy(F.desc(name), "file_id").limit(n)


def duplicate_ids(table: DataFrame, keys, file_id=None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return of_file(table, file_id).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def null_properties(table: DataFrame, key: str, file_id=None) -> DataFrame:
    """Rows without a file_id or generation_id."""
    missing = F.col("file_id").isNull() | F.col("generation_id").isNull()
    return of_file(table, file_id).where(missing).select(key, "file_id", "generation_id")


def placeholders(nodes: DataFrame, file_id=None) -> DataFrame:
    return of_file(nodes, file_id).where("placeholder").select("id", "file_id")


def tombstone_summary(node_tombstones: DataFrame, edge_tombstones: DataFrame, file_id=None) -> DataFrame:
    """One row: tombstone counts, (id, generation) pairs present more than once, and malformed ones."""
    kinds = [
        of_file(t, file_id).select(F.lit(kind).alias("kind"), "id", "generation_id", "file_id")
        for kind, t in (("node", node_tombstones), ("edge", edge_tombstones))
    ]
    broken = F.col("file_id").isNull() | F.col("generation_id").isNull()
    pairs = (
        kinds[0].unionByName(kinds[1])
        .groupBy("kind", "id", "generation_id")
        .agg(F.count("*").alias("n"), F.count_if(broken).alias("broken"))
    )
    of_kind = lambda kind: F.col("kind") == kind
    return pairs.agg(
        F.coalesce(F.sum(F.when(of_kind("node"), F.col("n"))), F.lit(0)).alias("node_tombstone_count"),
        F.coalesce(F.sum(F.when(of_kind("edge"), F.col("n"))), F.lit(0)).alias("edge_tombstone_count"),
        F.count_if(of_kind("node") & (F.col("n") > 1)).alias("duplicate_node_tombstones"),
        F.count_if(of_kind("edge") & (F.col("n") > 1)).alias("duplicate_edge_tombstones"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("malformed_tombstones"),
    )


def edge_type_distribution(edges: DataFrame) -> DataFrame:
    return edges.groupBy("edge_type").agg(F.count("*").alias("edges")).orderBy(F.desc("edges"), "edge_type")


def metadata_duplicates(metadata: DataFrame) -> DataFrame:
    """Files that break one of the two unique keys of the statistics table."""
    by_id = metadata.groupBy("file_id").count().where("count > 1")
    by_path = metadata.groupBy("repository_id", "file_path").count().where("count > 1")
    return by_id.select(F.lit("file_id").alias("broken_key"), F.col("file_id").alias("value"), F.col("count").alias("copies")).unionByName(
        by_path.select(
            F.lit("repository_id, file_path").alias("broken_key"),
            F.concat_ws("|", "repository_id", "file_path").alias("value"),
            F.col("count").alias("copies"),
        )
    )


def find_metadata(metadata: DataFrame, file_id=None, file_path=None) -> DataFrame:
    """Look statistics up by id or path."""
    rows = of_file(metadata, file_id)
    return rows if file_path is None else rows.where(F.col("file_path") == file_path)


def metadata_sample(metadata: DataFrame, n=3) -> DataFrame:
    return metadata.orderBy("file_path").limit(n)


def assert_unique(graph: dict[str, DataFrame]) -> None:
    """Uniqueness of node ids and of (id, generation) in both tombstone tables, before a snapshot is committed."""
    keys = {
        "nodes": ["id"],
        "edges": ["edge_id"],
        "node_tombstones": ["id", "generation_id"],
        "edge_tombstones": ["id", "generation_id"],
    }
    for name, key in keys.items():
        if not duplicate_ids(graph[name], key).isEmpty():
            raise ValueError(f"{name}: duplicate {', '.join(key)}")
