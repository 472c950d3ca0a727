"""Rows of one key, contiguous and in order, for a Python step that streams over them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence(partition: Column, offset: Column) -> Column:
    """Arrival order within a topic as one number: partition first, then offset."""
    return F.shiftleft(partition.cast("bigint"), 48) + offset


def in_runs(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add `place`, the row's number within its key, as last column.

    A window is a requirement the planner must meet in every replanning, unlike repartition + sort, which
    adaptive execution may optimise away below a Python step. Its rows come out contiguous by key and ordered,
    and it spills, so a task streaming over them holds no key in memory.
    """
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
