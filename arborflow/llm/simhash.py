"""Near-duplicate documents by SimHash: fingerprints, pigeonhole blocks, verified Hamming distance, components."""

from __future__ import annotations

from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import LOWER, clustered, group_starts, texts_of
from arborflow.llm.components import components
from arborflow.session import written

BITS = 64
SMALL_GROUP = 32  # groups up to this size are compared by shifted copies of the whole batch
LARGE_GROUP = 8192  # larger groups are dealt out again by more blocks


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the text's word shingles; 0 without words."""
    parts = (text or b"").translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size, digest = min(words, len(parts)), xxhash.xxh64_intdigest
    begin, end = starts[: len(parts) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(begin), 16_384):
        hashes = [digest(joined[a:b], seed) for a, b in zip(begin[at : at + 16_384], end[at : at + 16_384])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (long) of every row; one pass, no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            values = [fingerprint(text, words, seed) for text in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


def block_keys(fp, blocks: int, distance: int) -> list:
    """One key per choice of blocks - distance blocks: two fingerprints within the distance share at least one key."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(mask).cast("long"))))
    return keys


def _pairs_small(keys, fps, distance):
    """Links inside groups of at most SMALL_GROUP sorted rows."""
    for shift in range(1, SMALL_GROUP):
        same = keys[shift:] == keys[:-shift] if shift < len(keys) else np.zeros(0, bool)
        if not same.any():
            return
        at = np.flatnonzero(same)
        at = at[np.bitwise_count((fps[at] ^ fps[at + shift]).view(np.uint64)) <= distance]
        yield fps[at], fps[at + shift]


def _tree(fps, distance):
    """A spanning tree of each component of one group: fewer edges than rows however dense the group is."""
    left = np.sort(fps)
    ends, origins = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count((left ^ node).view(np.uint64)) <= distance
            if near.any():
                found, left = left[near], left[~near]
                ends.append(found)
                origins.append(np.full(len(found), node))
                queue.extend(found.tolist())
    return (np.concatenate(ends), np.concatenate(origins)) if ends else (fps[:0], fps[:0])


def _linker(distance, limit):
    """Edges (v set) inside the groups of equal key; groups over the limit come back as rows without v."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def out(u, v=None):
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.nulls(len(u), pa.int64()) if v is None else pa.array(v, pa.int64())], schema=schema)

    def whole(keys, fps):
        starts = group_starts(keys)
        sizes = np.diff(np.append(starts, len(keys)))
        small = np.repeat(sizes <= SMALL_GROUP, sizes)
        for u, v in _pairs_small(keys[small], fps[small], distance):
            yield out(u, v)
        for start, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
            group = fps[start : start + size]
            yield out(group) if limit and size > limit else out(*_tree(group, distance))

    def run(batches):
        keys, fps, over = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in chain(batches, [None]):
            if batch is not None:
                keys = np.concatenate((keys, batch.column("key").to_numpy()))
                fps = np.concatenate((fps, batch.column("fp").to_numpy()))
            if over is not None:  # the rest of a group that is being handed back
                cut = int(np.searchsorted(keys, over, "right"))
                yield out(fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
                over = None if len(keys) else over
            cut = int(np.searchsorted(keys, keys[-1], "left")) if batch is not None and len(keys) else len(keys)
            yield from whole(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
            if limit and len(keys) > limit:
                over = keys[-1]
                yield out(fps)
                keys, fps = keys[:0], fps[:0]

    return run


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints at the distance or less; distinct has fp.

    Pigeonhole: of b blocks at least b - distance agree. More blocks make longer keys and more rows; the first b
    follows the number of fingerprints, which changes the work only, never the links. Groups that stay too large
    are dealt out again by more blocks, at last by ones that leave so few free bits that a group is bounded.
    """
    count = distinct.count()
    sizes = [distance + 1, distance + 2, distance + 4, distance + 8]
    level = 0 if count < 1 << 17 else 1 if count < 1 << 25 else 2
    found = None
    for blocks in sizes[level:]:
        last = blocks == sizes[-1]
        rows = distinct.select("fp", F.explode(F.array(*block_keys(F.col("fp"), blocks, distance))).alias("key"))
        edges = written(clustered(rows, "key", "fp").mapInArrow(_linker(distance, 0 if last else LARGE_GROUP), "u long, v long"), "simhash-links")
        linked = edges.where(F.col("v").isNotNull())
        found = linked if found is None else found.union(linked)
        again = edges.where(F.col("v").isNull())
        if last or again.isEmpty():
            return found
        distinct = written(again.select(F.col("u").alias("fp")).distinct(), "simhash-again")


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links) of every row.

    Equal fingerprints are one node, so copies never meet in pairs. A null or empty text, or one of white space
    only, has fingerprint zero and links like any other. Rows with a null id get the component of their
    fingerprint (null if no row of it has an id). Repeated rows each come back; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, words, seed, id_col, text_col), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), distance), "simhash")
    placed = nodes.join(roots, F.col("fp") == F.col("u"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
