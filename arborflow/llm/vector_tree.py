"""Nearest neighbours by cosine through a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample, then every vector goes down to its leaf. A query goes through the tree with a
priority queue: the unvisited node with the nearest centre comes next, down to its best leaf, its other children are
queued. How many leaves it visits is widened until a sample of calibration queries, compared with all vectors, finds
the set share of its true neighbours. Leaves and the queries that visit them meet by an equi-join of tiles.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import NO_ID, by_key
from arborflow.llm.vectors import matrix, units, vector_rows
from arborflow.session import written

SAMPLE, SAMPLE_BYTES = 16_384, 128 << 20  # vectors that the tree is fitted on, and bytes of them
LEAF_ROWS = 2_048  # vectors of a leaf that the fit aims at, while a leaf has LEAF_SAMPLE of the sample
LEAF_SAMPLE = 16
BRANCHES, ROUNDS = 8, 8  # children of a node; rounds of k-means
CALIBRATION, RECALL = 256, 0.98  # queries that set the number of visits, and the share that they have to find
TILE_ROWS = 8_192  # a leaf's vectors that a task compares at a time
HELD_QUERIES = 50_000  # whose best rows a task adds up before it passes them on


class Tree:
    """Centres of all nodes, children of each inner one, and leaf numbers."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.centres, self.children, self.leaf_of, self.leaves = [], {}, {}, 0
        random = np.random.default_rng(7)
        share = rows / max(1, len(sample))
        self._grow(sample, share, random, sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1]))
        self.centres = np.array(self.centres)

    def _grow(self, points, share, random, centre) -> int:
        node = len(self.centres)
        self.centres.append(centre)
        k = min(BRANCHES, len(points) // LEAF_SAMPLE)
        if k >= 2 and len(points) * share > LEAF_ROWS:
            centres, owner = _kmeans(points, k, random)
            if len(np.unique(owner)) > 1:
                self.children[node] = np.array([self._grow(points[owner == c], share, random, centres[c]) for c in np.unique(owner)])
                return node
        self.leaf_of[node] = self.leaves
        self.leaves += 1
        return node

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point: the nearest child, from the root down."""
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node in self.leaf_of:
                out[at] = self.leaf_of[node]
                continue
            children = self.children[node]
            nearest = _distances(points[at], self.centres[children]).argmin(axis=1)
            todo += [(int(child), at[nearest == c]) for c, child in enumerate(children) if (nearest == c).any()]
        return out

    def visits(self, points: np.ndarray, least: int, held: np.ndarray, rows: int) -> list:
        """Best-bin-first leaves of each point: at least so many, and until they hold so many rows."""
        out = []
        for far in _distances(points, self.centres):
            queue, found, seen = [(0.0, 0)], [], 0
            while queue and (len(found) < least or seen < rows):
                _, node = heapq.heappop(queue)
                while node in self.children:
                    children = self.children[node]
                    order = children[np.argsort(far[children], kind="stable")].tolist()
                    node = order[0]
                    for other in order[1:]:
                        heapq.heappush(queue, (far[other], other))
                found.append(self.leaf_of[node])
                seen += held[self.leaf_of[node]]
            out.append(found)
        return out


def _distances(points, centres):
    return (centres**2).sum(axis=1) - 2 * (points @ centres.T)


def _kmeans(points, k, random):
    """k centres and each point's nearest; a centre that loses all its points is left as it is."""
    centres = points[random.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        owner = _distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        sizes = np.bincount(owner, minlength=k)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres, _distances(points, centres).argmin(axis=1)


def _calibrate(tree: Tree, nodes: DataFrame, queries: list, vectors: np.ndarray, kind: str, near: int, leaf_rows: np.ndarray) -> int:
    """Smallest number of visits by which the calibration queries find RECALL of their true neighbours."""
    own = {node: i for i, node in enumerate(queries)}

    def run(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(vectors)
        for batch in batches:
            points = units(matrix(batch.column("vector").to_pylist(), kind))
            leaf, cosine = batch.column("leaf").to_numpy(), vectors @ points.T
            for at, node in enumerate(batch.column("node").to_pylist()):
                if node in own:
                    cosine[own[node], at] = -2
            keep = np.argpartition(-cosine, min(near, cosine.shape[1]) - 1, axis=1)[:, :near] if cosine.size else np.zeros((len(vectors), 0), np.int64)
            for i, at in enumerate(keep):
                score, home = np.append(best[i][0], cosine[i, at]), np.append(best[i][1], leaf[at])
                order = np.argsort(-score, kind="stable")[:near]
                best[i] = score[order], home[order]
        query = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
        score, home = (np.concatenate([b[i] for b in best]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score), pa.array(home.astype(np.int64))], names=["query", "score", "leaf"])

    found = nodes.mapInArrow(run, "query long, score double, leaf long").where("score > -2")
    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "leaf"))
    truth = found.withColumn("rank", ranked).where(F.col("rank") <= near).select("query", "leaf").toArrow()  # at most CALIBRATION * near rows
    order = tree.visits(vectors, tree.leaves, leaf_rows, 0)
    place = [{leaf: i for i, leaf in enumerate(own)} for own in order]
    needed = np.sort([place[q][leaf] + 1 for q, leaf in zip(truth.column("query").to_pylist(), truth.column("leaf").to_pylist())])
    return int(needed[int(np.ceil(RECALL * len(needed))) - 1]) if len(needed) else tree.leaves


def _placed(tree, kind):
    """Each vector's leaf and tile of its leaf."""

    def run(batches):
        for batch in batches:
            leaf = tree.value.assign(units(matrix(batch.column("vector").to_pylist(), kind))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return run


def _visited(tree, kind, tiles, leaf_rows, least, rows):
    """A row per tile that a query visits."""
    schema = pa.schema([("tile", pa.int64()), ("query", pa.bool_()), ("node", pa.binary()), ("vector", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def run(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                leaves = tree.value.visits(units(matrix(batch.column("vector").to_pylist(), kind)), least, leaf_rows, rows)
                own = [[leaf << 32 | t for leaf in found for t in range(tiles[leaf])] for found in leaves]
                at = pa.array(np.repeat(np.arange(batch.num_rows), list(map(len, own))))
                count = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for o in own for t in o], pa.int64()), pa.array([True] * count, pa.bool_()), batch.column("node").take(at), batch.column("vector").take(at), pa.nulls(count, pa.list_(pa.int64()))],
                    schema=schema,
                )

    return run


def _compared(kind, kept):
    """The best `kept` rows for each query among the tiles of a task that it visits."""
    schema = pa.schema([("query", pa.binary()), ("score", pa.float64()), ("vec_id", pa.int64()), ("own", pa.bool_())])

    def out(best):
        rows = [(query, -far, i, own) for query, found in best.items() for far, i, own in found]
        columns = list(zip(*rows)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        best: dict = {}  # (-score, vec_id, own) of each query, best first

        def compare(queries, nodes, ids, stored):
            asked = units(matrix([q["vector"] for q in queries], kind))
            for query, vector, cosine in zip(queries, asked, asked @ stored.T):
                found = best.get(query["node"], [])
                least = -found[-1][0] if len(found) == kept else -2.0
                if len(cosine) > kept:
                    least = max(least, np.partition(cosine, -kept)[-kept])
                at = np.flatnonzero(cosine >= least - 1e-12)  # all that tie with the last
                score = np.einsum("ij,j->i", stored[at], vector)
                score[[nodes[i] == query["node"] for i in at]] = 1.0
                here = [(-s, i, nodes[a] == query["node"]) for a, s in zip(at.tolist(), np.clip(score, -1, 1).tolist()) for i in ids[a]]
                best[query["node"]] = sorted(found + here)[:kept]

        for _, rows in by_key(batches, "tile"):
            nodes, ids, points, held, stored = [], [], [], [], None
            for row in rows:
                if not row["query"]:
                    nodes.append(row["node"])
                    ids.append(row["ids"])
                    points.append(row["vector"])
                    continue
                if not points:
                    break  # a tile that no vector fell into
                if stored is None:
                    stored = units(matrix(points, kind))
                held.append(row)
                if len(held) == 256:
                    compare(held, nodes, ids, stored)
                    held = []
            if held:
                compare(held, nodes, ids, stored)
            if len(best) > HELD_QUERIES:
                yield out(best)
                best.clear()
        yield out(best)

    return run


def search(table: DataFrame, wanted: Column, near: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the `near` nearest rows found for each row that `wanted` holds for.

    Candidates are all rows but the query's own. Every row is indexed; the number of leaves that a query visits is
    calibrated for a recall of RECALL, and a query goes on until its leaves hold enough rows, so it has fewer results
    only if there are fewer candidates. Equal vectors are one point with their `near` + 1 smallest ids, which is all
    that a result can name; two vectors count as equal by a 128-bit digest. Null, empty and zero vectors and those
    with null or non-finite components take no part, nor do those of another length than most have (the shorter, if
    two lengths are as frequent). Rows of one id are rows of their own; a null id comes after all others among ties.
    An empty table gives no rows. Columns other than the two named are not read, but for `wanted`.
    """
    spark, kept = table.sparkSession, near + 1
    rows, kind = vector_rows(table, id_col, vector_col, wanted=F.coalesce(wanted, F.lit(False)))
    rows = written(rows.where(F.col("vector").isNotNull()).withColumn("node", F.unhex(F.md5("vector"))), "vectors")
    lengths = rows.groupBy(F.length("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.length("vector") == (lengths[0] if lengths else 0))
    least_id = Window.partitionBy("node").orderBy(F.col("id"))
    named = rows.select("node", "vector", F.coalesce("vec_id", F.lit(NO_ID)).alias("id")).withColumn("place", F.row_number().over(least_id)).where(F.col("place") <= kept)
    nodes = written(named.groupBy("node").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")), "vectors-nodes")
    count = nodes.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], schema)

    width = nodes.select(F.length("vector")).first()[0]
    size = min(SAMPLE, max(LEAF_SAMPLE, SAMPLE_BYTES // width))
    # A hash of the vector draws about twice as many as needed, so that the limit is reached on any table.
    drawn = nodes.select("node", "vector").withColumn("draw", F.xxhash64("node", F.lit(1)))
    share = min(1.0, 2 * size / count)
    drawn = drawn.where(F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("draw").limit(size).toArrow()
    points = units(matrix(drawn.column("vector").to_pylist(), kind))
    tree = Tree(points, count)
    shared = spark.sparkContext.broadcast(tree)  # at most 2 * SAMPLE / LEAF_SAMPLE centres

    placed = nodes.mapInArrow(_placed(shared, kind), "node binary, vector binary, ids array<long>, leaf long")
    placed = written(placed, "vectors-leaves")
    leaf_rows = np.zeros(tree.leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # one row per leaf
        leaf_rows[row["leaf"]] = row["count"]
    picked = min(CALIBRATION, len(points))
    least = _calibrate(tree, placed, drawn.column("node").to_pylist()[:picked], points[:picked], kind, near, leaf_rows)

    tiles = np.maximum(1, -(-leaf_rows // TILE_ROWS)).tolist()
    slices = F.get(F.array(*[F.lit(t) for t in tiles]), F.col("leaf").cast("int")) if max(tiles) > 1 else F.lit(1)
    stored = placed.select((F.shiftleft("leaf", 32) + F.pmod(F.xxhash64("node"), slices)).alias("tile"), F.lit(False).alias("query"), "node", "vector", "ids")
    asked = rows.where("wanted").groupBy("node").agg(F.first("vector").alias("vector"))
    asked = asked.mapInArrow(_visited(shared, kind, tiles, leaf_rows, least, kept), "tile long, query boolean, node binary, vector binary, ids array<long>")
    met = stored.union(asked).repartition("tile").sortWithinPartitions("tile", "query")
    found = written(met.mapInArrow(_compared(kind, kept), "query binary, score double, vec_id long, own boolean"), "vectors-found")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= kept)
    lists = found.groupBy(F.col("query").alias("node")).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "own"))).alias("found"))
    queries = rows.where("wanted").select("node", F.col("vec_id").alias("query_id")).join(lists, "node")
    mine = F.array_position(F.transform("found", lambda x: x["own"] & (x["vec_id"] == F.coalesce("query_id", F.lit(NO_ID)))), True)
    others = F.slice(F.filter("found", lambda x, i: i + 1 != mine), 1, near)
    out = queries.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.nullif("x.vec_id", F.lit(NO_ID)).alias("vec_id"), (-F.col("x.far")).alias("score"))
