"""Phrase collocations from sorted count streams.

Counting goes from one word to five, a pass over the texts for each length: a phrase is counted only if the filter of
the length before holds both its parts. The counted phrases are then kept twice, ordered by their beginnings and by
their ends. Both orders are walked in step with the candidates' own stream (sort-merge joins): the one gives the counts
of left parts and of phrases with a word more on the right, the other those of right parts and of a word more on the
left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import group_starts, gram_hashes, texts_of, word_codes
from arborflow.session import written

LONGEST, LEAST, TOP = 5, 100, 2000
UNKNOWN = "und"
FILTER_BITS = 26  # 8 MB; a fuller filter passes more phrases to the count, which decides
HELD_WORDS = 1_000_000  # words that a task counts at a time, whole texts; results do not depend on it
RANKED = 50_000  # candidates of a language that the first ranking takes at a time

# A-Z become a-z, a tab a space, and every piece separator the first of them, which no word holds.
PIECES = bytes(46 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text: bytes | None) -> list:
    """Words in order, with b"." between pieces."""
    return (text or b"").translate(PIECES).replace(b".", b" . ").split()


def _places(codes: np.ndarray, lang: str) -> np.ndarray:
    """Filter bits of phrases of a language."""
    return (codes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - FILTER_BITS)


def _passes(bits: np.ndarray, codes: np.ndarray, lang: str) -> np.ndarray:
    at = _places(codes, lang)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _counts(words: list, lang: str, size: int, bits) -> tuple:
    """Distinct phrases of `size` words that may be frequent, and their counts."""
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    names = list(known)
    real = np.array([name != b"." for name in names], bool)
    if size == 1:
        counts = np.bincount(ids, minlength=len(names))
        return [names[i] for i in np.flatnonzero(real)], counts[real]
    inside = real[ids]
    codes = word_codes(names)[ids]
    starts = np.arange(max(0, len(ids) - size + 1))
    for step in range(size):
        starts = starts[inside[starts + step]]
    parts = np.arange(max(0, len(ids) - size + 2))
    fine = _passes(bits, gram_hashes(codes, parts, size - 1), lang)
    starts = starts[fine[starts] & fine[starts + 1]]
    if not len(starts):
        return [], starts
    rank = ids[starts]
    for step in range(1, size):  # equal ranks are equal phrases, not only equal hashes
        _, rank = np.unique(rank * len(names) + ids[starts + step], return_inverse=True)
    _, first, counts = np.unique(rank, return_index=True, return_counts=True)
    owners = ids[starts[first][:, None] + np.arange(size)].tolist()
    return [b" ".join([names[i] for i in own]) for own in owners], counts


def _counter(size: int, bits):
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("f", pa.int64())])

    def run(batches):
        held: dict = {}
        total = 0

        def flush():
            for lang, words in held.items():
                phrases, counts = _counts(words, lang, size, bits and np.frombuffer(bits.value, np.uint8))
                counts = counts.astype(np.int64)
                if size == 1 and len(counts):  # all words of the language
                    phrases, counts = [*phrases, None], np.append(counts, counts.sum())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()), pa.array(counts)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch, "text")):
                words = held.setdefault(lang, [])
                found = tokens(text)
                words += found
                words.append(b".")
                total += len(found)
                if total > HELD_WORDS:
                    yield from flush()
                    held, total = {}, 0
        yield from flush()

    return run


def _filter_words(size: int):
    """Words of 64 filter bits that the frequent phrases set."""
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            phrases = [p.split(b" ") for p in texts_of(batch, "phrase")]
            codes = gram_hashes(word_codes([w for p in phrases for w in p]), np.arange(0, len(phrases) * size, size), size)
            at = np.zeros(len(codes), np.uint64)
            for lang in set(langs):
                at[langs == lang] = _places(codes[langs == lang], lang)
            at = np.unique(at)
            word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            starts = group_starts(word)
            bits = np.bitwise_or.reduceat(bit, starts) if len(at) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word[starts].astype(np.int64)), pa.array(bits.view(np.int64))], schema=schema)

    return run


def _filter(frequent: DataFrame, size: int) -> bytes:
    """A bitmap of fixed size over the frequent phrases."""
    words = frequent.select("lang", "phrase").mapInArrow(_filter_words(size), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bitmap.astype("<u8").tobytes()


def count_streams(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple:
    """(grams, totals): lang, phrase, size, f of every phrase of up to `longest` words that stands `least` times or
    more; lang and n, the number of all words, per language.

    Every word of a frequent phrase, and every part of it, is at least as frequent, so filtering by the length before
    loses none. Partial counts are added up before they are shuffled, so a hot phrase is one row per task.
    """
    source = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    grams, totals, bits = None, None, None
    for size in range(1, longest + 1):
        counted = source.mapInArrow(_counter(size, bits), "lang string, phrase binary, f long")
        counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | F.col("phrase").isNull())
        counted = written(counted.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(size).alias("size"), "f"), f"grams-{size}")
        frequent = counted.where(F.col("phrase").isNotNull())
        if size == 1:
            totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
        grams = frequent if grams is None else grams.union(frequent)
        if size < longest:
            bits = context.broadcast(_filter(frequent, size))  # of fixed size
    return grams, totals


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language with their rank; each round ranks groups of bounded size."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    groups, count = 1, scored.count()
    while groups * RANKED < count:
        groups *= 16
    while groups > 1:
        part = F.pmod(F.xxhash64("phrase"), F.lit(groups))
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top).drop("rank")
        groups //= 16
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to `longest` words.

    A phrase's score is the smallest over its cuts of floor(1000 * a * n / (l * r)), from exact decimals of 38 digits:
    n may reach 10^17 words. A phrase that a longer frequent one holds as often as it stands itself is left out: then
    one with one word more does so too, as no phrase is rarer than one that holds it. A null text has no words, a null
    language is `und`; repeated rows count each; an empty table gives no rows. Only the two named columns are read.
    """
    grams, totals = count_streams(docs, longest, least, text_col, lang_col)
    grams = written(grams, "grams")
    candidates = grams.where(F.col("size") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), cut)
    begins = F.expr("substring_index(phrase, ' ', k)")
    ends = F.expr("substring_index(phrase, ' ', k - size)")
    prefixes = cuts.select("*", begins.alias("part"))
    suffixes = cuts.select("*", ends.alias("part"))

    def walked(stream, name):
        """The stream in the order of its part, in step with the counts in that order."""
        parts = grams.select("lang", F.col("phrase").alias("part"), F.col("f").alias(name))
        return stream.hint("merge").join(parts.hint("merge"), ["lang", "part"])

    left = walked(prefixes, "l").select("lang", "phrase", "size", "a", "k", "l")
    right = walked(suffixes, "r").select("lang", "phrase", "k", "r")
    both = left.hint("merge").join(right.hint("merge"), ["lang", "phrase", "k"]).join(totals, "lang")
    score = F.expr("cast((cast(1000 * cast(a as decimal(19,0)) as decimal(38,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)")
    lowest = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = prefixes.where("size > 2 and k = size - 1").union(suffixes.where("size > 2 and k = 1")).groupBy("lang", "part").agg(F.max("a").alias("held"))
    longer = longer.withColumnRenamed("part", "phrase")
    scored = lowest.hint("merge").join(longer.hint("merge"), ["lang", "phrase"], "left").where(F.col("held").isNull() | (F.col("held") < F.col("a")))
    scored = written(scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "phrases")
    return _best(scored, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
