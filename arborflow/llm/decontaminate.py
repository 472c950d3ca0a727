"""Benchmark passages in documents, by winnowed k-gram fingerprints that are joined and extended to whole windows.

Of each run of WINDOW k-grams both sides keep the smallest hash, so every span of WINDOW + GRAM - 1 words that they
share has a fingerprint in common. Shorter items are one window each and are looked up by n-grams of their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import ITEM_WORDS, as_batch, gram_hashes, texts_of, word_codes, worker_cache
from arborflow.session import written

SPAN = 10  # words of a window
GRAM, WINDOW = 5, 6  # WINDOW + GRAM - 1 == SPAN
HELD_WORDS = 250_000  # words that a task holds at a time, whole texts; results do not depend on it
FILTER_BITS = 24  # the filter of fingerprints has 2**24 bits (2 MB), however large the benchmark is


def words_of(text: bytes | None) -> list:
    return (text or b"").translate(ITEM_WORDS).split()


def _winnow(codes: np.ndarray, owners: np.ndarray):
    """Hash of each k-gram, and of each whole window its start and smallest hash."""
    grams = gram_hashes(codes, np.arange(len(codes) - GRAM + 1), GRAM)
    starts = np.arange(len(codes) - SPAN + 1)
    starts = starts[owners[starts] == owners[starts + SPAN - 1]]
    least = grams[starts]
    for step in range(1, WINDOW):
        least = np.minimum(least, grams[starts + step])
    return grams, starts, least


def _short_hashes(codes, owners, size):
    """Hashes of all n-grams that lie in one text."""
    starts = np.arange(len(codes) - size + 1)
    starts = starts[owners[starts] == owners[starts + size - 1]]
    return starts, gram_hashes(codes, starts, size, 0xA0761D6478BD642F)


def _flushes(batches, id_name):
    held, words = [], 0
    for batch in batches:
        extra = batch.column("carried").to_pylist() if "carried" in batch.schema.names else [None] * batch.num_rows
        for key, text, carried in zip(batch.column(id_name).to_pylist(), texts_of(batch, "text"), extra):
            held.append((key, words_of(text), carried))
            words += len(held[-1][1])
            if words >= HELD_WORDS or len(held) >= 100_000:
                yield held
                held, words = [], 0
    if held:
        yield held


def _arrays(held):
    parts = [words for _, words, _ in held]
    sizes = np.array([len(p) for p in parts])
    flat = [word for words in parts for word in words]
    return flat, word_codes(flat), np.repeat(np.arange(len(held)), sizes), np.cumsum(sizes) - sizes, sizes


ITEM_SCHEMA = pa.schema([("item_id", pa.string()), ("hash", pa.int64()), ("offset", pa.int32()), ("size", pa.int32()), ("span", pa.string())])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, hash, offset, size and span (words joined by spaces) of every window of every item."""

    def run(batches):
        for held in _flushes(batches, "item_id"):
            flat, codes, owners, begins, sizes = _arrays(held)
            out = {f.name: [] for f in ITEM_SCHEMA}

            def add(start, size, hash_, offset):
                values = (held[owners[start]][0], int(np.array(hash_, np.uint64).view(np.int64)), offset, size, b" ".join(flat[start : start + size]).decode())
                for name, value in zip(out, values):
                    out[name].append(value)

            if len(flat) >= SPAN:
                grams, starts, least = _winnow(codes, owners)
                for start, hash_ in zip(starts.tolist(), least):
                    add(start, SPAN, hash_, int(np.argmax(grams[start : start + WINDOW] == hash_)))
            for begin, size in zip(begins.tolist(), sizes.tolist()):
                if 0 < size < SPAN:
                    add(begin, size, gram_hashes(codes, np.array([begin]), size, 0xA0761D6478BD642F)[0], 0)
            yield as_batch(out, ITEM_SCHEMA)

    source = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "item_id string, hash long, offset int, size int, span string")


def _filter_of(windows: DataFrame) -> np.ndarray:
    """Bit array of the fingerprints; the driver gets its set words, 2**18 numbers at most."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    rows = windows.select((bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 as int))").alias("bit"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in rows.groupBy("word").agg(F.bit_or("bit")).collect():
        table[word] = bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


DOC_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hash", pa.int64()), ("at", pa.int64()), ("left", pa.int32()), ("context", pa.string()), ("carried", pa.binary())])
DOC_DDL = "row long, doc_id long, n_words long, hash long, at long, left int, context string, carried binary"


def _document_rows(packed_filter, shorts):
    """A row for each document, and one for each of its fingerprints that passes the filter, with the words around it."""

    def run(batches):
        from pyspark import TaskContext

        worker_cache("decontaminate")
        bits = np.unpackbits(np.frombuffer(packed_filter.value, np.uint8)).astype(bool)
        row = TaskContext.get().partitionId() << 40
        known = lambda h: bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        for held in _flushes(batches, "doc_id"):
            flat, codes, owners, begins, sizes = _arrays(held)
            out = {f.name: [] for f in DOC_SCHEMA}
            none = [None] * len(held)
            for name, values in zip(out, (range(row, row + len(held)), [k for k, _, _ in held], sizes.tolist(), none, none, none, none, [c for *_, c in held])):
                out[name].extend(values)

            def add(places, found, before, after):
                for place, hash_ in zip(places.tolist(), found.view(np.int64).tolist()):
                    owner = owners[place]
                    first = max(place - before, begins[owner])
                    context = b" ".join(flat[first : min(place + after, begins[owner] + sizes[owner])]).decode()
                    for name, value in zip(out, (row + int(owner), held[owner][0], None, hash_, place - int(begins[owner]), place - int(first), context, None)):
                        out[name].append(value)

            if len(flat) >= SPAN:
                grams, starts, least = _winnow(codes, owners)
                kept = np.zeros(len(grams), bool)
                for step in range(WINDOW):
                    kept[starts[grams[starts + step] == least] + step] = True
                places = np.flatnonzero(kept)
                places = places[known(grams[places])]
                add(places, grams[places], WINDOW - 1, SPAN)
            for size in shorts:
                if len(flat) >= size:
                    starts, found = _short_hashes(codes, owners, size)
                    good = known(found)
                    add(starts[good], found[good], 0, size)
            row += len(held)
            yield as_batch(out, DOC_SCHEMA)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carried: Column | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as strings) and contaminated of every document.

    With `carried`, a column of bytes, its value comes along under that name, to tell rows of one id apart.

    One pass over the documents emits only fingerprints that pass a filter of fixed size over the benchmark's, with
    the words around; an equi-join with the benchmark's windows and a comparison of the words themselves decide.
    Null or empty texts have no words; items without words have no windows. An item without id makes hits but is
    not listed; items of one id count once. Repeated documents each come back; empty tables give no hits or rows.
    """
    spark = docs.sparkSession
    windows = written(item_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    packed = spark.sparkContext.broadcast(np.packbits(_filter_of(windows)).tobytes())
    shorts = sorted(r[0] for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect())  # nine at most
    extra = [] if carried is None else [carried.alias("carried")]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *extra)
    rows = written(source.mapInArrow(_document_rows(packed, shorts), DOC_DDL), "benchmark-hits")

    spans = windows.select("hash", "offset", "size", "span").distinct()
    words = F.slice(F.split("context", " "), F.col("left") - F.col("offset") + 1, F.col("size"))
    hits = rows.where(F.col("n_words").isNull()).join(spans, "hash").where(F.col("left") >= F.col("offset"))
    hits = hits.where(F.array_join(words, " ") == F.col("span"))
    hits = hits.select("row", (F.col("at") - F.col("offset")).alias("start"), "size", "span").distinct()
    hits = written(hits, "benchmark-spans")

    from pyspark.sql import Window

    ahead = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(ahead), F.lit(0))))
    covered = hits.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    items = hits.select("row", "span").distinct().join(windows.where(F.col("item_id").isNotNull()).select("span", "item_id").distinct(), "span")
    items = items.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    base = rows.where(F.col("n_words").isNotNull()).select("row", "doc_id", "n_words", *(["carried"] if extra else []))
    return base.join(covered, "row", "left").join(items, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        *(["carried"] if extra else []),
    )
