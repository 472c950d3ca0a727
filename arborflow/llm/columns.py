"""Column helpers for operators that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def item_words(text: Column) -> Column:
    """A-Z lower-cased, words (digits, a-z, beyond ASCII) joined by one space each."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), ITEM_SEPARATORS, " "))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("int"), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each of many integers the sum of those before it, by blocks of about the root of their number."""

    def with_width(values, width):
        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int"))
        block_sums = F.transform(blocks, lambda k: total(F.slice(values, k * width + 1, width)))
        return let(
            block_sums,
            lambda sums: F.transform(
                values,
                lambda _, i: total(F.slice(sums, F.lit(1), F.floor(i / width).cast("int"))) + total(F.slice(values, i - i % width + 1, i % width)),
            ),
        )

    return F.when(F.size(values) > 0, let(F.ceil(F.sqrt(F.size(values))).cast("int"), lambda width: with_width(values, width))).otherwise(F.array().cast("array<int>"))


def found_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end (code points, end exclusive) and value (the group) of each leftmost match that does not overlap."""
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
        F.split(text, pattern, -1).alias("between"),
    )

    def spans(m):
        sizes = F.transform(m["all"], lambda w, i: F.length(w) + F.length(m["between"][i]))
        return let(
            sizes,
            lambda sizes: let(
                sums_before(sizes),
                lambda before: F.transform(
                    m["all"],
                    lambda w, i: F.struct((before[i] + F.length(m["between"][i])).alias("start"), (before[i] + sizes[i]).alias("end"), m["values"][i].alias("value")),
                ),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(none)


FILTER_BITS = 24  # of a bitmap: 2**18 rows, whatever is put in
BITMAP_COLUMNS = ("__set", "__word", "__bits", "__bit")


def _place(hash_: Column) -> tuple:
    """(word, bit) of a hash in a bitmap of 64-bit words."""
    at = F.shiftrightunsigned(hash_, 64 - FILTER_BITS)
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63).cast("long")).cast("int")


def bitmap(hashes: DataFrame) -> DataFrame:
    """A bitmap over the column `hash` as rows (word, bits): at most 2**(FILTER_BITS - 6), so it may be broadcast."""
    word, _ = _place(F.col("hash"))
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 as int))")
    return hashes.select(word.alias("__word"), bit.alias("bit")).groupBy("__word").agg(F.bit_or("bit").alias("__bits"))


def marked(rows: DataFrame, hash_: Column, bits: DataFrame) -> DataFrame:
    """rows with `__set`: the hash may be in the bitmap."""
    word, bit = _place(hash_)
    joined = rows.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(bits), "__word", "left")
    return joined.withColumn("__set", F.coalesce(F.expr("getbit(__bits, __bit) = 1"), F.lit(False))).drop("__word", "__bits", "__bit")


def document_key(id_col: str, text_col: str) -> Column:
    """16 bytes for a document's id and text."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.md5(F.col(text_col)), F.lit("-")))))


def without(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents of the given keys (column `key`); only rows that a bitmap of the keys passes are shuffled."""
    keys = keys.select(F.col("key").alias("__key")).distinct()
    found = marked(docs.withColumn("__key", document_key(id_col, text_col)), F.xxhash64("__key"), bitmap(keys.select(F.xxhash64("__key").alias("hash"))))
    kept = found.where("__set").join(keys, "__key", "left_anti")
    return found.where("NOT __set").select(*docs.columns).unionByName(kept.select(*docs.columns))
