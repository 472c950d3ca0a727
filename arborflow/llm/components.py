"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.session import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, root) for each node that is not its component's smallest; edges has u and v (long), in any direction.

    Each round ties every node to the smallest neighbour of its larger, then of its smaller neighbours, and writes
    the edges to the shared folder, so that a lost executor costs one round. Rounds grow with the logarithm of the
    nodes. Minima are aggregates with map-side combine; a node with very many neighbours is a skewed join, which
    adaptive execution splits. Null ends and loops are left out; repeated edges count once.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = written(edges.where(F.col("u") != F.col("v")).select(high, low).distinct(), f"{name}-edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return edges.select("u", F.col("v").alias("root"))
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(nearest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(nearest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(smaller.distinct(), f"{name}-edges")
