"""Near copies by the Jaccard similarity of their five-word shingles, found by long SimHash fingerprints.

At similarity 0.8 a bit of two fingerprints agrees with a chance of 0.85: too little for blocks that must all but
agree. So blocks are short, there are many of them, and both follow the number of texts: their length keeps groups
small, their number gives near copies a common one with a chance of RECALL. Inside a group the Hamming distance of the
whole fingerprint proposes, one pair for each text, and the shingles decide:

* first each text goes with the first one that is so close that the similarity is all but sure (a tree per group);
* then, round by round, with the nearest texts that it is not connected to yet and was not compared with, one in the
  first round and GROWTH times as many in each further one, until no text has any left; one that has none left leaves
  the rounds.

So texts that are connected are not compared again, and the number of pairs follows the number of texts and of their
neighbours that turn out to be less similar, however large the groups of near copies are.
"""

from __future__ import annotations

import math
from itertools import chain
from itertools import count as count_up

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.columns import BITMAP_COLUMNS, bitmap, document_key, marked
from arborflow.llm.common import FLUSH_WORDS, LOWER, clustered, gram_hashes, group_starts, id_or_last, mix, texts_of, word_codes, worker_cache
from arborflow.llm.components import components
from arborflow.session import written

WORDS, SIMILARITY = 5, 0.8
PARTS = 4  # fingerprints of 64 bits
BITS = 64 * PARTS
AGREE = 0.8485  # chance that a bit agrees at the similarity: 1 - acos(2s / (1 + s)) / pi
RECALL = 0.99  # of pairs at the similarity, by common blocks
GROUP_ROWS = 256  # texts of a block's group that the length of blocks aims at
LARGE_GROUP = 8192  # larger groups are dealt again by longer blocks, at last in tiles of two slices
LONGER = (0, 6, 12)  # bits that blocks grow by
CLOSE, FAR = 22, 56  # bits of BITS: 39 +- 6 differ at the similarity, 22 +- 4 at 0.93
GROWTH = 4  # neighbours that a text may name, from round to round
COMPARED = 1 << 20  # distances that a task holds at a time
FINGERPRINT = [f"f{i}" for i in range(PARTS)]


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a text of fewer words is one shingle."""
    parts = (text or b"").translate(LOWER).split()
    size = min(WORDS, len(parts))
    return np.unique(gram_hashes(word_codes(parts), np.arange(len(parts) - size + 1), size)) if parts else np.zeros(0, np.uint64)


def _parts(hashes: np.ndarray) -> np.ndarray:
    """PARTS independent SimHash fingerprints of a set of shingles."""
    counts = np.zeros(BITS, np.int64)
    seeds = np.arange(1, PARTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 255):
        octets = mix(hashes[at : at + 255, None] ^ mix(seeds)[None]).astype("<u8").view(np.uint8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")


def _fingerprints(batches):
    names = ["rank", "key", "node", *FINGERPRINT]
    worker_cache("near_copies")
    for batch in batches:
        sets = [shingles(text) for text in texts_of(batch, "text")]
        parts = np.array([_parts(s) for s in sets], np.int64).reshape(-1, PARTS)
        nodes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("key"), nodes, *[pa.array(parts[:, i]) for i in range(PARTS)]], names=names)


def _sets(batches):
    """node and shingles of each text."""
    schema = pa.schema([("node", pa.binary()), ("hashes", pa.list_(pa.int64()))])
    worker_cache("near_copies")
    for batch in batches:
        nodes, sets, held = [], [], 0
        for node, text in zip(batch.column("node").to_pylist(), texts_of(batch, "text")):
            nodes.append(node)
            sets.append(shingles(text).view(np.int64))
            held += len(sets[-1])
            if held > FLUSH_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, schema.field(1).type)], schema=schema)
                nodes, sets, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, schema.field(1).type)], schema=schema)


def plan(rows: int, longer: int = 0) -> tuple:
    """(bits, number) of blocks for so many texts."""
    bits = max(8, math.ceil(math.log2(max(rows, 1) / GROUP_ROWS))) + longer
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE**bits))


def _block_keys(bits: int, number: int) -> list:
    """Key columns: disjoint blocks of a shuffled fingerprint, shuffled anew when it is used up."""
    random, left, keys = np.random.default_rng(bits), [], []
    for block in range(number):
        if len(left) < bits:
            left = random.permutation(BITS).tolist()
        chosen, left = left[:bits], left[bits:]
        words = []
        for part in range(PARTS):
            mask = sum(1 << (b - 64 * part) for b in chosen if b // 64 == part)
            words.append(F.col(f"f{part}").bitwiseAND(F.lit(mask - ((mask >> 63) << 64)).cast("long")))
        keys.append(F.xxhash64(F.lit(bits * 65536 + block), *words))
    return keys


def _dealt(nodes: DataFrame, rows: int, large: list) -> DataFrame:
    """Texts by block: key and all columns of nodes. `large` has the keys of too large groups of each length."""
    out = None
    for longer, keys in zip(LONGER, large):
        dealt = nodes.select("*", F.explode(F.array(*_block_keys(*plan(rows, longer)))).alias("key"))
        if keys is not None:
            found = dealt.join(keys, "key", "left")
            dealt = found.where("slices IS NULL").drop("slices")
            over = found.where("slices IS NOT NULL")
            if longer == LONGER[-1]:
                # Any two slices share a tile, so any two texts of the group meet.
                own = F.pmod(F.xxhash64("node", "key"), F.col("slices")).cast("int")
                over = over.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
                tile = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
                dealt = dealt.unionByName(over.withColumn("key", tile).drop("own", "other", "slices"))
        out = dealt if out is None else out.unionByName(dealt)
        if keys is None:
            break
        nodes = nodes.join(over.select("node").distinct(), "node", "left_semi")
    return clustered(out, "key", "node")


def _large_groups(nodes: DataFrame, rows: int) -> list:
    """Per length of blocks the keys of groups over LARGE_GROUP, and their numbers of slices; None ends the list."""
    out = []
    for longer in LONGER:
        keys = nodes.select("node", F.explode(F.array(*_block_keys(*plan(rows, longer)))).alias("key"))
        over = keys.groupBy("key").count().where(F.col("count") > LARGE_GROUP).select("key", F.ceil(F.col("count") / LARGE_GROUP).cast("int").alias("slices"))
        over = written(over, "near-large")
        if over.isEmpty():
            return [*out, None]
        out.append(over)
        nodes = nodes.join(keys.join(over, "key", "left_semi").select("node").distinct(), "node", "left_semi")
    return out


def _halves(column) -> np.ndarray:
    """16-byte values as two integers each; nulls as zeros."""
    return np.frombuffer(b"".join(v or bytes(16) for v in column.to_pylist()), "<i8").reshape(-1, 2)


def _distances(prints, a, b):
    return sum(np.bitwise_count((f[a, None] ^ f[b]).view(np.uint64)).astype(np.uint8, copy=False).astype(np.int16) for f in prints)


def _tree_links(prints):
    """(i, j) with j < i: a forest over the pairs of one group that are CLOSE; and which rows have any not FAR one."""
    size = len(prints[0])
    near, ones, others = np.zeros(size, bool), [], []
    root = np.arange(size)
    step = max(1, COMPARED // size)
    for a in range(0, size, step):
        b = min(a + step, size)
        far = _distances(prints, slice(a, b), slice(0, b))
        before = np.arange(b) < np.arange(a, b)[:, None]
        hits = (far <= FAR) & before
        near[:b] |= hits.any(axis=0)
        near[a:b] |= hits.any(axis=1)
        close = (far <= CLOSE) & before
        for i in np.flatnonzero(close.any(axis=1)):
            found = np.flatnonzero(close[i])
            first = np.unique(root[found], return_index=True)[1]  # one link to each tree that it touches
            ones += [a + i] * len(first)
            others += found[first].tolist()
            joined = np.isin(root, root[found]) if len(first) > 1 else root == root[found[0]]
            joined[a + i] = True
            root[joined] = root[found].min()
    return ones, others, np.flatnonzero(near)


def _nearest(prints, root, nodes, refused, most):
    """(i, j, distance): of each row up to `most` of the nearest rows of another root, not refused and not FAR."""
    size = len(prints[0])
    step = max(1, COMPARED // size)
    place = {node: j for j, node in enumerate(nodes)} if any(refused) else {}
    for a in range(0, size, step):
        b = min(a + step, size)
        far = _distances(prints, slice(a, b), slice(0, size))
        far[(root[a:b, 0, None] == root[None, :, 0]) & (root[a:b, 1, None] == root[None, :, 1])] = BITS
        for i in range(a, b) if place else ():
            far[i - a, [place[v] for v in refused[i] or () if v in place]] = BITS
        for i in np.flatnonzero((far <= FAR).any(axis=1)):
            found = np.flatnonzero(far[i] <= FAR)
            found = found[np.argsort(far[i, found], kind="stable")[:most]]
            yield np.full(len(found), a + i), found, far[i, found]


def _regions(batches, columns):
    """(rows, starts, ends): whole groups of the sorted batches, as one table and the bounds of those of two rows or more."""
    held = None
    for batch in chain(batches, [None]):
        if batch is not None:
            rows = pa.Table.from_batches([batch.select(columns)])
            held = rows if held is None else pa.concat_tables([held, rows])
        if held is None or not held.num_rows:
            continue
        keys = held.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left")) if batch is not None else len(keys)
        if cut:
            starts = group_starts(keys[:cut])
            ends = np.append(starts[1:], cut)
            several = ends - starts > 1
            yield held.slice(0, cut), starts[several].tolist(), ends[several].tolist()
            held = held.slice(cut)


def _proposed(most: int):
    """Rows (u, v, far). First (`most` is 0): links of trees, and (u, null, null) for texts with any near; later the nearest."""
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary()), ("far", pa.int32())])
    columns = ["key", "node", *FINGERPRINT, *(["root", "refused"] if most else [])]

    def run(batches):
        worker_cache("near_copies")
        for rows, starts, ends in _regions(batches, columns):
            all_prints = [rows.column(f).to_numpy() for f in FINGERPRINT]
            nodes = pa.concat_arrays(rows.column("node").chunks)
            root = _halves(rows.column("root")) if most else None
            u, v, far = [], [], []
            for start, end in zip(starts, ends):
                prints = [f[start:end] for f in all_prints]
                if not most:
                    ones, others, near = _tree_links(prints)
                    u += [np.array(ones, np.int64) + start, near + start]
                    v += [np.array(others, np.int64) + start, np.full(len(near), -1)]
                elif not (root[start:end] == root[start]).all():
                    own, refused = nodes.slice(start, end - start).to_pylist(), rows.column("refused").slice(start, end - start).to_pylist()
                    for i, j, d in _nearest(prints, root[start:end], own, refused, most):
                        u.append(i + start)
                        v.append(j + start)
                        far.append(d)
            if u:
                u, v = np.concatenate(u), np.concatenate(v)
                distance = pa.array(np.concatenate(far).astype(np.int32)) if far else pa.nulls(len(u), pa.int32())
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(u)), nodes.take(pa.array(v, mask=v < 0)), distance], schema=schema)

    return run


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with `similar`: their shingles' Jaccard similarity reaches SIMILARITY."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    counted = both.select("u", "v", shared.alias("shared"), (F.size("a") + F.size("b")).alias("total"))
    return counted.select("u", "v", (F.col("shared") >= SIMILARITY * (F.col("total") - F.col("shared"))).alias("similar"))


def _state(nodes: DataFrame, roots: DataFrame, judged: DataFrame) -> DataFrame:
    """nodes with their root; `refused` also has what they were compared with in judged, at either end, and is less similar."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other"))))
    tried = judged.where("NOT similar").select(ends.alias("pair")).groupBy("pair.node").agg(F.collect_set("pair.other").alias("tried"))
    state = nodes.join(roots.select(F.col("u").alias("node"), "root"), "node", "left").join(tried, "node", "left")
    refused = F.when(F.col("tried").isNull(), F.col("refused")).otherwise(F.concat("refused", "tried"))
    return state.select("node", *FINGERPRINT, F.coalesce("root", "node").alias("root"), refused.alias("refused"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(u, root) after further links: components of the roots that these tie together, which are few."""
    for end in ("u", "v"):
        own = roots.select(F.col("u").alias(end), F.col("root").alias("above"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("above", end)).drop("above")
    tied = components(links, "near-merged")
    above = tied.select(F.col("u").alias("root"), F.col("root").alias("top"))
    lifted = roots.join(above, "root", "left").select("u", F.coalesce("top", "root").alias("root"))
    return written(lifted.unionByName(tied), "near-roots")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key (of id and text), doc_id, component_id and first_key of every row.

    A link joins texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more; no other does. Equal
    sets are one node (by a 128-bit digest), so copies never meet. component_id is the smallest doc_id that links
    reach, first_key the document of that id (of several, the smallest key). A null id comes after all others. Texts
    without words are one group. All texts that share a block and are not FAR end up connected or compared, whatever
    the size of their group; a link may be missed only if its two texts have no common block (1 - RECALL at the
    similarity) or are FAR (3 standard deviations at the similarity).
    """
    key = document_key(id_col, text_col).alias("key")
    source = docs.select(id_or_last(id_col).alias("rank"), key, F.col(text_col).alias("text"))
    longs = ", ".join(f"{f} long" for f in FINGERPRINT)
    rows = written(source.mapInArrow(_fingerprints, f"rank long, key binary, node binary, {longs}"), "near-rows")
    first = F.min(F.struct("rank", "key")).alias("first")
    nodes = written(rows.groupBy("node").agg(first, *[F.min(f).alias(f) for f in FINGERPRINT]), "near-nodes")
    count, prints = nodes.count(), nodes.select("node", *FINGERPRINT)
    large = _large_groups(prints, count)

    schema = "u binary, v binary, far int"
    met = _dealt(prints, count, large).mapInArrow(_proposed(0), schema)
    met = written(met.groupBy("u").agg(F.min("v").alias("v")), "near-met")
    # Shingles are needed of texts with a near one only, of one document each; the bitmap is of fixed size.
    wanted = met.select(F.col("u").alias("node")).join(nodes, "node").select("node", F.col("first.key").alias("key"))
    wanted = written(wanted, "near-wanted")
    found = marked(source, F.xxhash64("key"), bitmap(wanted.select(F.xxhash64("key").alias("hash")))).where("__set").select("key", "text")
    sets = found.join(wanted, "key").select("node", "text").mapInArrow(_sets, "node binary, hashes array<long>")
    sets = written(sets.dropDuplicates(["node"]), "near-sets")

    judged = written(_compared(met.where("v IS NOT NULL"), sets), "near-judged")
    roots = components(judged.where("similar").select("u", "v"), "near-roots")
    left = prints.join(wanted.select("node"), "node").withColumn("refused", F.array().cast("array<binary>"))
    for again in count_up():
        most = GROWTH**again  # so rounds follow the logarithm of the neighbours of a text
        state = written(_state(left, roots, judged), "near-state")
        nearest = _dealt(state, count, large).mapInArrow(_proposed(most), schema)
        nearest = nearest.groupBy("u", "v").agg(F.min("far").alias("far"))
        nearest = nearest.withColumn("place", F.row_number().over(Window.partitionBy("u").orderBy("far", "v"))).where(F.col("place") <= most)
        nearest = written(nearest.select("u", "v", "place"), "near-nearest")
        named = nearest.agg(F.max("place")).first()[0] or 0
        if named:
            judged = written(_compared(nearest.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), sets), "near-judged")
            similar = judged.where("similar").select("u", "v")
            if not similar.isEmpty():
                roots = _merged(roots, similar)
        if named < most:
            break
        # A text that named fewer has met all its neighbours: what is left need not meet it again.
        more = nearest.where(F.col("place") == most).select(F.col("u").alias("node"))
        left = state.drop("root").join(more, "node", "left_semi")
    placed = nodes.join(roots.select(F.col("u").alias("node"), "root"), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("first").alias("winner")), "root").select("node", "winner")
    given = lambda c: F.nullif(c, F.lit((1 << 63) - 1))
    return rows.join(named, "node").select("key", given(F.col("rank")).alias("doc_id"), given(F.col("winner.rank")).alias("component_id"), F.col("winner.key").alias("first_key"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest id, and of one id of the smallest key.

    Rows are told apart by id and text, so a row that shares its id with a copy stays if its own text is no copy; of
    rows that are equal in both one stays. Texts are shuffled only of documents with copies.
    """
    found = written(near_copies(docs, id_col, text_col), "near-copies")
    fates = found.groupBy("key").agg(F.count("*").alias("n"), F.min("first_key").alias("first_key"))
    fates = written(fates.where("key <> first_key OR n > 1").select(F.col("key").alias("__key"), (F.col("key") == F.col("first_key")).alias("__once")), "near-fates")
    names = [c for c in docs.columns if c not in (*BITMAP_COLUMNS, "__key", "__once")]
    keyed = marked(docs.withColumn("__key", document_key(id_col, text_col)), F.xxhash64("__key"), bitmap(fates.select(F.xxhash64("__key").alias("hash"))))
    judged = keyed.where("__set").join(fates, "__key", "left")
    kept = keyed.where("NOT __set").select(*names).unionByName(judged.where("__once IS NULL").select(*names))
    if fates.where("__once").isEmpty():
        return kept
    return kept.unionByName(judged.where("__once").dropDuplicates(["__key"]).select(*names))
