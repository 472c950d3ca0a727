"""Definition-use edges: which definitions of a variable may reach each of its uses, per scope.

Variables do not influence each other, so the unit of work is one variable of one scope: its definitions and
uses in evaluation order, each with the `if` arms and loops around it. Spark spreads these runs by
(file, scope, variable) and sorts each in evaluation order; a task then streams over its sorted rows holding
only the run it is in, so no group is ever collected, and a run is bounded by one source file's size.

What reaches a point follows the usual gen/kill rules: a definition replaces what was there, the arms of an
`if` are united, and a loop adds its own definitions to what entered it without replacing that. Pairs go out as they
are found; a run holds its definitions and the uses of its open loops.
"""

from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.functions.runs import in_runs
from arborflow.operators.flatten import syntax_rows
from arborflow.operators.reaching import reaching_pairs
from arborflow.operators.syntax_graph import EDGE_COLUMNS, edge, own_id

_RUN = ["file_id", "scope_seq", "variable"]
_PAIR_SCHEMA = "file_id string, source_id string, target_id string, variable string, scope string"
_PAIRS_PER_BATCH = 20_000


def accesses(flat: DataFrame) -> DataFrame:
    """Every definition and use as data-flow evaluation meets it."""
    met = F.explode("reads").alias("read")
    return (
        syntax_rows(flat)
        .where(F.col("reads").isNotNull())
        .select("file_id", "scope_seq", F.col("semantic_key").alias("variable"), "scope_name", own_id().alias("node_id"), met)
        .select(*_RUN, "scope_name", "node_id", "read.at", "read.kind", "read.frames")
    )


def _pair_batches(batches):
    def rows():
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns])

    held = []
    for (file_id, _, variable, scope), run in groupby(rows(), key=lambda r: r[:4]):
        events = ((kind, node, [(f["seq"], f["arm"]) for f in frames]) for *_, node, _, kind, frames, _ in run)
        for source, target in reaching_pairs(events):
            held.append((file_id, source, target, variable, scope))
            if len(held) >= _PAIRS_PER_BATCH:
                yield _batch(held)
                held = []
    if held:
        yield _batch(held)


def _batch(rows):
    names = ["file_id", "source_id", "target_id", "variable", "scope"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)


def dfg_edges(flat: DataFrame) -> DataFrame:
    runs = in_runs(accesses(flat), _RUN, "at")
    told = F.to_json(F.struct("variable", "scope", F.lit("REACHING_DEFINITION").alias("resolution")))
    role = F.concat(F.lit("dfg|"), F.col("variable"))
    return (
        runs.mapInArrow(_pair_batches, _PAIR_SCHEMA)
        .select(*edge(F.col("source_id"), F.col("target_id"), "DFG_DEF_USE", role, told))
        .select(EDGE_COLUMNS)
    )
