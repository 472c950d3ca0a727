"""Removal of word spans repeated across documents, found by difference-cover anchors.

A window of `size` words that two texts share holds, in both, an anchor of size - PERIOD + 1 words at a position
that is in COVER modulo PERIOD: whatever the two offsets are, some shift below PERIOD brings both into the cover.
So only anchors are hashed and compared over the corpus. Windows around anchors that occur in two texts are then
extended to full size and compared by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import FLUSH_WORDS, as_batch, blob, by_key, clustered, gram_hashes, group_starts, id_or_last, texts_of, unblob, word_codes
from arborflow.session import written

PERIOD, COVER = 7, (0, 1, 3)  # every difference modulo 7 is one of two members of the cover
BUCKET_ENTRIES = 3_000_000  # anchors or windows a task compares at a time; the number of buckets follows the corpus
TAIL_BITS = 40  # bits of an anchor's hash kept beside its bucket: a false match only costs a later comparison
MARK = (1 << 24) - 1  # instead of a text number: the anchor occurs in several texts of its flush


def _content(docs, id_col, text_col):
    """id (null last) and content key of each row, and its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), id_or_last(id_col).alias("rank"), F.unhex(F.md5(text)).alias("content"), text.alias("text"))


def _flushes(batches):
    """Lists of (content, text, words) of about FLUSH_WORDS words; a content once in each list."""
    held, seen, words = [], set(), 0
    for batch in batches:
        for content, text in zip(batch.column("content").to_pylist(), texts_of(batch, "text")):
            if content in seen:
                continue
            seen.add(content)
            parts = text.split()
            held.append((content, text, parts))
            words += len(parts)
            if words >= FLUSH_WORDS or len(held) >= 100_000:
                yield held
                held, seen, words = [], set(), 0
    if held:
        yield held


def _cover_positions(words: int, anchor: int) -> np.ndarray:
    at = np.arange(max(0, words - anchor + 1))
    return at[np.isin(at % PERIOD, COVER)]


ANCHOR_SCHEMA = pa.schema([("bucket", pa.int64()), ("entries", pa.binary()), ("content", pa.binary()), ("places", pa.binary())])
PLACE_SCHEMA = pa.schema([("content", pa.binary()), ("places", pa.binary())])
ANCHOR_DDL = "bucket long, entries binary, content binary, places binary"


def _anchor_rows(size, bucket_bits):
    """Per flush: packed anchors by bucket, and (bucket below 0) places whose anchor recurs in another of its texts."""
    anchor = size - PERIOD + 1

    def run(batches):
        for held in _flushes(batches):
            codes, places, texts, offset = [], [], [], 0
            for number, (_, _, parts) in enumerate(held):
                if len(parts) >= size:
                    at = _cover_positions(len(parts), anchor)
                    codes.append(word_codes(parts))
                    places.append(at + offset)
                    texts.append(np.full(len(at), number))
                    offset += len(parts)
            if not codes:
                continue
            begins = np.zeros(len(held), np.int64)
            long = [n for n, (_, _, parts) in enumerate(held) if len(parts) >= size]
            begins[long] = np.concatenate(([0], np.cumsum([len(c) for c in codes])[:-1]))
            codes, places, texts = np.concatenate(codes), np.concatenate(places), np.concatenate(texts)
            keys = gram_hashes(codes, places, anchor)
            order = np.lexsort((texts, keys))
            keys, texts, places = keys[order], texts[order], (places - begins[texts])[order]
            starts = group_starts(keys)
            shared = texts[starts] != texts[np.append(starts[1:], len(keys)) - 1]
            widths = np.diff(np.append(starts, len(keys)))
            again = np.repeat(shared, widths)
            rows = {"bucket": [], "entries": [], "content": [], "places": []}
            for number, spots in _per_text(texts[again], places[again]):
                _add(rows, bucket=-1 - number, content=held[number][0], places=blob(spots, 5))
            keep = ~again
            keep[starts[shared]] = True
            keys, texts, places = keys[keep], np.where(again, MARK, texts)[keep], places[keep]
            for bucket, begin, end in _slices(keys, bucket_bits):
                own = np.unique(texts[begin:end])
                own = own[own != MARK]
                contents = b"".join(held[number][0] for number in own)
                tails = keys[begin:end] >> np.uint64(64 - bucket_bits - TAIL_BITS) & np.uint64((1 << TAIL_BITS) - 1)
                short = np.where(texts[begin:end] == MARK, MARK, np.searchsorted(own, texts[begin:end]))
                _add(rows, bucket=bucket, entries=_join(contents, blob(np.diff(tails, prepend=np.uint64(0)), 5), blob(short, 3), blob(places[begin:end], 5)))
            yield as_batch(rows, ANCHOR_SCHEMA)

    return run


def _add(rows, **values):
    for name, column in rows.items():
        column.append(values.get(name))


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _split(data: bytes) -> list:
    parts, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        parts.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return parts


def _per_text(texts, places):
    """(text, its places) for each text."""
    order = np.argsort(texts, kind="stable")
    texts, places = texts[order], places[order]
    starts = group_starts(texts)
    for begin, end in zip(starts, np.append(starts[1:], len(texts))):
        yield int(texts[begin]), places[begin:end]


def _slices(sorted_keys, bucket_bits):
    """(bucket, begin, end) of sorted keys by their leading bits."""
    buckets = (sorted_keys >> np.uint64(64 - bucket_bits)) if bucket_bits else np.zeros(len(sorted_keys), np.uint64)
    starts = group_starts(buckets)
    for begin, end in zip(starts, np.append(starts[1:], len(buckets))):
        yield int(buckets[begin]), int(begin), int(end)


def _shared_anchors(batches):
    """Places of anchors that occur in more than one text, by content; those that are known already pass through."""
    for bucket, rows in by_key(batches, "bucket"):
        if bucket < 0:
            known = [(row["content"], row["places"]) for row in rows]
            yield as_batch({"content": [c for c, _ in known], "places": [p for _, p in known]}, PLACE_SCHEMA)
            continue
        contents, tails, texts, places = {}, [], [], []
        for row in rows:
            own, tail, short, at = _split(row["entries"])
            numbers = np.array([contents.setdefault(own[i : i + 16], len(contents)) for i in range(0, len(own), 16)] + [-1])
            short = unblob(short, 3).astype(np.int64)
            tails.append(np.cumsum(unblob(tail, 5), dtype=np.uint64))
            texts.append(numbers[np.where(short == MARK, len(numbers) - 1, short)])
            places.append(unblob(at, 5))
        tails, texts, places = np.concatenate(tails), np.concatenate(texts), np.concatenate(places)
        order = np.lexsort((texts, tails))
        tails, texts, places = tails[order], texts[order], places[order]
        starts = group_starts(tails)
        ends = np.append(starts[1:], len(tails))
        again = np.repeat(texts[starts] != texts[ends - 1], ends - starts) & (texts >= 0)
        names = list(contents)
        out = {"content": [], "places": []}
        for number, spots in _per_text(texts[again], places[again]):
            _add(out, content=names[number], places=blob(spots, 5))
        yield as_batch(out, PLACE_SCHEMA)


WINDOW_SCHEMA = pa.schema(
    [("content", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.binary()), ("places", pa.binary()), ("bucket", pa.int64()), ("entries", pa.binary())]
)
WINDOW_DDL = "content binary, n_words long, n_removed long, kept_sha256 string, text binary, places binary, bucket long, entries binary"


def _sha(words) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _merged(rows):
    """Rank, places and text of one content."""
    rank, spots, text = None, [], None
    for row in rows:
        rank = row["rank"] if row["rank"] is not None else rank
        if row["places"] is not None:
            spots.append(unblob(row["places"], 5).astype(np.int64))
        text = row["text"] if row["text"] is not None and text is None else text
    return rank, np.unique(np.concatenate(spots)) if spots else np.zeros(0, np.int64), text


def _window_rows(size, bucket_bits):
    """Texts without shared anchors are done; of the others come the windows to compare and the texts."""
    anchor = size - PERIOD + 1

    def flush(held):
        codes = np.concatenate([c for *_, c, _ in held])
        sizes = np.array([len(c) for *_, c, _ in held])
        begins = np.cumsum(sizes) - sizes
        at = np.concatenate([starts + begin for (*_, starts), begin in zip(held, begins)])
        owner = np.repeat(np.arange(len(held)), [len(starts) for *_, starts in held])
        ranks = np.array([rank for _, rank, *_ in held])[owner]
        first, second = gram_hashes(codes, at, size), gram_hashes(codes, at, size, 0xD1B54A32D192ED03)
        order = np.lexsort((ranks, second, first))
        first, second, ranks, owner = first[order], second[order], ranks[order], owner[order]
        at = at[order] - begins[owner]
        starts = group_starts(first, second)
        least = np.repeat(ranks[starts], np.diff(np.append(starts, len(first))))
        later = ranks > least
        rows = {f.name: [] for f in WINDOW_SCHEMA}
        gone = dict(_per_text(owner[later], at[later]))
        for number, (content, _, text, codes, _) in enumerate(held):
            spots = gone.get(number, np.zeros(0, np.int64))
            _add(rows, content=content, n_words=len(codes), text=text, places=blob(spots, 5))
        first, second, owner, at = first[~later], second[~later], owner[~later], at[~later]
        for bucket, begin, end in _slices(first, bucket_bits):
            own = np.unique(owner[begin:end])
            contents = b"".join(held[number][0] for number in own)
            rank_bytes = np.array([held[number][1] for number in own], "<i8").tobytes()
            short = np.searchsorted(own, owner[begin:end])
            entries = _join(contents, rank_bytes, blob(np.diff(first[begin:end], prepend=np.uint64(0)), 8), blob(second[begin:end], 8), blob(short, 3), blob(at[begin:end], 5))
            _add(rows, bucket=bucket, entries=entries)
        return as_batch(rows, WINDOW_SCHEMA)

    def run(batches):
        held, words = [], 0
        done = {f.name: [] for f in WINDOW_SCHEMA}
        for content, rows in by_key(batches, "content"):
            rank, spots, packed = _merged(rows)
            parts = zstandard.decompress(packed).split()
            starts = np.zeros(0, np.int64)
            if len(spots) and len(parts) >= size:
                marks = np.zeros(len(parts) + 1, np.int64)
                marks[spots + 1] = 1
                total = np.cumsum(marks)
                last = np.arange(len(parts) - size + 1)
                starts = last[total[last + PERIOD] > total[last]]
            if not len(starts):
                _add(done, content=content, n_words=len(parts), n_removed=0, kept_sha256=_sha(parts))
                if len(done["content"]) >= 5_000:
                    yield as_batch(done, WINDOW_SCHEMA)
                    done = {f.name: [] for f in WINDOW_SCHEMA}
                continue
            held.append((content, rank, packed, word_codes(parts), starts))
            words += len(parts)
            if words >= FLUSH_WORDS:
                yield flush(held)
                held, words = [], 0
        if held:
            yield flush(held)
        yield as_batch(done, WINDOW_SCHEMA)

    return run


def _later_windows(batches):
    """Starts of windows that also start in a text of smaller rank, by content."""
    for _, rows in by_key(batches, "bucket"):
        contents, ranks, parts = {}, {}, []
        for row in rows:
            own, rank, first, second, short, at = _split(row["entries"])
            numbers = np.array([contents.setdefault(own[i : i + 16], len(contents)) for i in range(0, len(own), 16)])
            ranks.update(zip(numbers.tolist(), np.frombuffer(rank, "<i8").tolist()))
            parts.append((np.cumsum(unblob(first, 8), dtype=np.uint64), unblob(second, 8), numbers[unblob(short, 3).astype(np.int64)], unblob(at, 5)))
        first, second, texts, places = (np.concatenate(column) for column in zip(*parts))
        rank = np.array([ranks[number] for number in range(len(contents))])[texts]
        order = np.lexsort((rank, second, first))
        first, second, texts, places, rank = first[order], second[order], texts[order], places[order], rank[order]
        starts = group_starts(first, second)
        later = rank > np.repeat(rank[starts], np.diff(np.append(starts, len(first))))
        names = list(contents)
        out = {"content": [], "places": []}
        for number, spots in _per_text(texts[later], places[later]):
            _add(out, content=names[number], places=blob(spots, 5))
        yield as_batch(out, PLACE_SCHEMA)


RESULT_SCHEMA = pa.schema([("content", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.list_(pa.int64())))])


def _spans(gone: np.ndarray) -> list:
    """[start, end) of each run of removed words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    return edges.reshape(-1, 2).tolist()


def _cut_texts(size):
    """Words left of each text once the windows that start at its places are out."""

    def run(batches):
        out = {f.name: [] for f in RESULT_SCHEMA}
        for content, rows in by_key(batches, "content"):
            _, spots, packed = _merged(rows)
            parts = zstandard.decompress(packed).split()
            marks = np.zeros(len(parts) + 1, np.int64)
            marks[spots] += 1
            np.subtract.at(marks, spots + size, 1)
            gone = np.cumsum(marks[:-1]) > 0
            kept = [word for word, out_ in zip(parts, gone.tolist()) if not out_]
            _add(out, content=content, n_words=len(parts), n_removed=int(gone.sum()), kept_sha256=_sha(kept), removed=_spans(gone))
            if len(out["content"]) >= 5_000:
                yield as_batch(out, RESULT_SCHEMA)
                out = {f.name: [] for f in RESULT_SCHEMA}
        yield as_batch(out, RESULT_SCHEMA)

    return run


def _packed_texts(batches):
    """content and compressed text, once per content and batch."""
    schema = pa.schema([("content", pa.binary()), ("text", pa.binary())])
    for held in _flushes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([c for c, *_ in held], pa.binary()), pa.array([zstandard.compress(t, 1) for _, t, _ in held], pa.binary())], schema=schema)


def remove_repeats(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed [start, end) word spans of every row.

    Words are runs without ASCII white space. A word goes if a window of `size` words over it also starts in a document with a smaller id. Equal texts are
    one content, so a large group of copies is handled once; later copies lose every word, if they have `size`.
    A null text has no words. A null id counts as larger than all others. Rows with one id count as one document:
    none removes words of another. Repeated rows each come back; an empty table gives no rows.
    """
    rows = _content(docs, id_col, text_col)
    texts = rows.select("content", "text")
    narrow = rows.select("doc_id", "rank", "content")
    firsts = narrow.groupBy("content").agg(F.min("rank").alias("rank"))
    total = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    bucket_bits = max(4, math.ceil(math.log2(1 + total / 12 / BUCKET_ENTRIES)))

    anchors = texts.mapInArrow(_anchor_rows(size, bucket_bits), ANCHOR_DDL)
    places = clustered(anchors, "bucket").mapInArrow(_shared_anchors, "content binary, places binary")

    def united(texts, places):
        none = [F.lit(None).cast(kind) for kind in ("long", "binary", "binary")]
        both = places.select("content", none[0].alias("rank"), "places", none[2].alias("text"))
        return both.unionByName(texts.select("content", "rank", F.col("places"), "text"))

    scanned = texts.mapInArrow(_packed_texts, "content binary, text binary")
    joined = united(scanned.select("content", F.lit(None).cast("long").alias("rank"), F.lit(None).cast("binary").alias("places"), "text"), places)
    joined = joined.unionByName(firsts.select("content", "rank", F.lit(None).cast("binary").alias("places"), F.lit(None).cast("binary").alias("text")))
    windows = written(clustered(joined, "content").mapInArrow(_window_rows(size, bucket_bits), WINDOW_DDL), "substring-windows")

    packed = windows.where(F.col("bucket").isNotNull()).select("bucket", "entries")
    later = clustered(packed, "bucket").mapInArrow(_later_windows, "content binary, places binary")
    open_texts = windows.where(F.col("text").isNotNull()).select("content", F.lit(None).cast("long").alias("rank"), "places", "text")
    cut = clustered(united(open_texts, later), "content").mapInArrow(_cut_texts(size), "content binary, n_words long, n_removed long, kept_sha256 string, removed array<array<long>>")
    done = windows.where(F.col("kept_sha256").isNotNull()).select("content", "n_words", "n_removed", "kept_sha256", F.array().cast("array<array<bigint>>").alias("removed"))
    results = cut.union(done).join(firsts.withColumnRenamed("rank", "first"), "content")

    copy = (F.col("rank") > F.col("first")) & (F.col("n_words") >= size)
    return narrow.join(results, "content").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))).otherwise(F.col("removed")).alias("removed"),
    )
