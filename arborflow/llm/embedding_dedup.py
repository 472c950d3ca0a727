"""Near-duplicate vectors by collision counting over one-dimensional random projections.

Two vectors at the cosine threshold differ by a known length, so along a random direction their projections differ
by a normal variable of known spread. The share of directions in which a window of fixed width centred on one holds
the other follows, and with it the number of collisions that all but a set share of such pairs reach: RECALL fixes
the counts, no data do. Rows first meet in cells, ranges of a few leading projections; tables of independent cells
make up for pairs that a range's bound parts. In a cell, pairs that collide often enough are verified by cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import clustered, group_starts
from arborflow.llm.components import components
from arborflow.llm.vectors import matrix, units, vector_rows
from arborflow.session import written

RECALL = 0.985  # of pairs exactly at the threshold, for the cells; the count keeps 0.995 of those
COUNTED = 16  # projections whose windows are counted
CELL_ROWS = 1024  # rows of a cell that the number of leading projections aims at
TILE_ROWS = 2048  # larger cells are dealt out as pairs of slices


def _share_within(width: float) -> float:
    return math.erf(width / math.sqrt(2))


def plan(rows: int, cosine: float) -> dict:
    """Widths, numbers of leading projections and tables, and smallest count for a threshold and a number of rows."""
    spread = math.sqrt(2 * (1 - cosine))
    cell = 4 * spread

    def same_cell(s):  # chance that a randomly placed range of the cell's width holds both of a pair of spread s
        r = cell / s
        return _share_within(r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))

    leading = max(1, math.ceil(math.log(max(rows, CELL_ROWS + 1) / CELL_ROWS) / -math.log(same_cell(math.sqrt(2)))))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - same_cell(spread) ** leading))
    window, chance = 1.5 * spread, _share_within(1.5)
    reach = lambda least: sum(math.comb(COUNTED, c) * chance**c * (1 - chance) ** (COUNTED - c) for c in range(least, COUNTED + 1))
    return {"cell": cell, "leading": leading, "tables": tables, "window": window, "least": max(c for c in range(COUNTED + 1) if reach(c) >= 0.995)}


def _directions(dimension: int, settings: dict):
    """Counted and leading directions, the latter with offsets: the same on every worker."""
    random = np.random.default_rng(20_011 + dimension)
    counted = random.normal(size=(COUNTED, dimension))
    leading = random.normal(size=(settings["tables"] * settings["leading"], dimension))
    return counted, leading, random.uniform(0, settings["cell"], len(leading))


def _places(points: np.ndarray, leading: np.ndarray, offsets: np.ndarray, settings: dict) -> np.ndarray:
    """Cell of each vector in each table, as the numbers of its ranges: rows x tables x leading projections."""
    # Sums in a fixed order: a vector has the same cells in whatever batch it comes.
    values = np.stack([np.einsum("ij,j->i", points, direction) for direction in leading], axis=1)
    return np.floor((values + offsets) / settings["cell"]).astype("<i8").reshape(len(points), settings["tables"], settings["leading"])


def _by_length(data: list) -> list:
    """Places of the vectors of each length."""
    sizes = np.array([len(d) for d in data])
    return [np.flatnonzero(sizes == size) for size in np.unique(sizes)]


def _celled(settings, kind):
    """A row per vector and table: node, table, cell."""
    schema = pa.schema([("node", pa.binary()), ("table", pa.int32()), ("cell", pa.int64())])

    def run(batches):
        from xxhash import xxh64_intdigest

        known: dict = {}
        for batch in batches:
            data, nodes = batch.column("vector").to_pylist(), batch.column("node")
            for at in _by_length(data):
                points = units(matrix([data[i] for i in at], kind))
                size = points.shape[1]
                _, leading, offsets = known.setdefault(size, _directions(size, settings))
                places = _places(points, leading, offsets, settings)
                for table in range(settings["tables"]):
                    cells = [xxh64_intdigest(row.tobytes(), seed=size * 4096 + table) - (1 << 63) for row in places[:, table]]
                    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(at)), pa.array(np.full(len(at), table, np.int32)), pa.array(cells, pa.int64())], schema=schema)

    return run


def _with_cells(settings, kind):
    """Each vector, with its cells, once per table: what a tile needs of it, and no more."""
    schema = pa.schema([("node", pa.binary()), ("copies", pa.int64()), ("vector", pa.binary()), ("table", pa.int32()), ("cell", pa.int64())])

    def run(batches):
        for batch in batches:
            for cells in _celled(settings, kind)([batch]):
                place = pa.compute.index_in(cells.column("node"), value_set=batch.column("node"))
                yield pa.RecordBatch.from_arrays([cells.column("node"), batch.column("copies").take(place), batch.column("vector").take(place), cells.column("table"), cells.column("cell")], schema=schema)

    return run


def _compared(settings, cosine, kind):
    """Per tile: links of each vector (copies of its partners), and edges that connect the tile's linked vectors."""
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary()), ("n", pa.int64())])

    def tile(rows, known):
        for at in _by_length(rows["vector"]):  # two lengths meet by a collision of cell hashes only
            if len(at) > 1:
                yield from own_length({n: [c[i] for i in at] for n, c in rows.items()}, known)

    def own_length(rows, known):
        points = units(matrix(rows["vector"], kind))
        size = points.shape[1]
        counted, leading, offsets = known.setdefault(size, _directions(size, settings))
        values = np.ascontiguousarray((points @ counted.T).T)
        nodes, copies, slices = rows["node"], np.array(rows["copies"]), np.array(rows["slice"])
        places, table, cross = _places(points, leading, offsets, settings), rows["table"][0], rows["cross"][0]
        total, label, edges = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), []
        for begin in range(0, len(nodes), 256):
            block = slice(begin, begin + 256)
            hits = np.zeros((len(nodes[block]), len(nodes) - begin), np.int8)
            for row in values:
                hits += np.abs(row[block, None] - row[None, begin:]) <= settings["window"]
            one, other = np.nonzero(hits >= settings["least"])
            one, other = one + begin, other + begin
            keep = (other > one) & ((slices[one] != slices[other]) if cross else True)
            one, other = one[keep], other[keep]
            keep = np.einsum("ij,ij->i", points[one], points[other]) >= cosine
            one, other = one[keep], other[keep]
            common = (places[one] == places[other]).all(axis=2)
            first = common.any(axis=1) & (common.argmax(axis=1) == table)  # each pair counts in its first table only
            np.add.at(total, one[first], copies[other[first]])
            np.add.at(total, other[first], copies[one[first]])
            for start, end in zip(starts := group_starts(one), np.append(starts[1:], len(one))):
                here = one[start]
                others = np.unique(label[other[start:end]])
                others = others[others != label[here]]
                if len(others):
                    edges += [(nodes[here], nodes[o]) for o in others]
                    label[np.isin(label, others)] = label[here]
        linked = np.flatnonzero(total).tolist()
        u = [nodes[i] for i in linked] + [a for a, _ in edges]
        v = [None] * len(linked) + [b for _, b in edges]
        n = [int(total[i]) for i in linked] + [None] * len(edges)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(n, pa.int64())], schema=schema)

    def run(batches):
        known: dict = {}
        held, key = None, None
        for batch in batches:
            keys = batch.column("tile").to_numpy()
            columns = {n: batch.column(n).to_pylist() for n in ("node", "copies", "vector", "table", "slice", "cross")}
            starts = group_starts(keys)
            for start, end in zip(starts, np.append(starts[1:], len(keys))):
                part = {n: c[start:end] for n, c in columns.items()}
                if held is not None and key == keys[start]:
                    held = {n: held[n] + part[n] for n in held}
                    continue
                if held is not None and len(held["node"]) > 1:
                    yield from tile(held, known)
                held, key = part, keys[start]
        if held is not None and len(held["node"]) > 1:
            yield from tile(held, known)

    return run


def near_duplicates(table: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: links are pairs of cosine >= the threshold.

    No pair below it is linked; of those above, at least RECALL (0.98 with the count) at the threshold itself and
    more the closer they are. Equal vectors (by a 128-bit digest) are one node with a number of copies, whatever their
    ids. Vectors that are null, empty, zero or hold null or non-finite components, and vectors of another length, link
    with nothing. Rows without an id are compared like all others; a null id is never a component's name while another
    id is there, and is not kept. Rows of one id and different vectors are judged each by its own vector. An empty
    table gives no rows.
    """
    rows, kind = vector_rows(table, id_col, vector_col)
    rows = written(rows.withColumn("node", F.unhex(F.md5("vector"))), "vectors")
    groups = rows.where(F.col("vector").isNotNull()).groupBy("node").agg(F.first("vector").alias("vector"), F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    groups = written(groups, "vectors-distinct")
    settings = plan(groups.count(), cosine)

    # Cells of one vector join nothing; their vectors stay where they are.
    keys = groups.select("node", "vector").mapInArrow(_celled(settings, kind), "node binary, table int, cell long").groupBy("cell").count()
    shared = written(keys.where("count > 1").select("cell", F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("slices")), "vectors-cells")
    spread = groups.select("node", "copies", "vector").mapInArrow(_with_cells(settings, kind), "node binary, copies long, vector binary, table int, cell long")
    spread = spread.join(shared, "cell")
    spread = spread.withColumn("slice", F.pmod(F.xxhash64("node", "table"), F.col("slices")).cast("int"))
    spread = spread.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tile = F.xxhash64("cell", "table", F.least("slice", "partner"), F.greatest("slice", "partner"))
    spread = spread.select(tile.alias("tile"), "node", "copies", "vector", "table", "slice", (F.col("slice") != F.col("partner")).alias("cross"))
    found = clustered(spread, "tile").mapInArrow(_compared(settings, cosine, kind), "u binary, v binary, n long")
    found = written(found, "vectors-links")

    linked = found.where(F.col("n").isNotNull()).groupBy("u").agg(F.sum("n").alias("n")).select(F.col("u").alias("node"), "n")
    roots = components(found.where(F.col("v").isNotNull()).select("u", "v"), "vectors").select(F.col("u").alias("node"), "root")
    placed = groups.select("node", "first_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.join(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").join(linked, "node", "left")
    nodes = named.select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id")
    judged = rows.where(F.col("vector").isNotNull()).join(nodes, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("vector").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return judged.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
