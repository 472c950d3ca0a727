"""Removal of repeated multi-line chunks, with chunk bounds that the lines themselves choose.

A rolling hash over the hashes of two neighbouring lines is taken at every line. Where it recurs in the corpus, the two
lines are a seed; seeds that follow each other join into one chunk, whose bounds lie where the rolling hash stops
recurring. Lines put in or taken out elsewhere move no such bound, a shared passage of two lines or more always has a
seed at each of its lines, and a single line never is a chunk. Hashes only propose: what counts as repeated is decided
by the lines' bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.columns import BITMAP_COLUMNS, bitmap, document_key, let, marked
from arborflow.llm.common import id_or_last
from arborflow.session import written

OWN = ("n_lines", "n_chunks", "n_removed_lines")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def rolling_hashes(lines: Column) -> Column:
    """(at, hash) of every two neighbouring lines that hold more than white space; at least two lines are given."""

    def pairs(lines):
        hashes = F.transform(lines, lambda line: F.xxhash64(line))
        blank = F.transform(lines, lambda line: ~line.rlike(r"\S"))
        known = F.struct(hashes.alias("h"), blank.alias("b"))
        pair = lambda k, i: F.struct(i.alias("at"), F.when(~(k["b"][i] & k["b"][i + 1]), F.xxhash64(k["h"][i], k["h"][i + 1])).alias("hash"))
        return let(known, lambda k: F.transform(F.sequence(F.lit(0), F.size(k["h"]) - 2), lambda i: pair(k, i)))

    return F.filter(pairs(lines), lambda s: s["hash"].isNotNull())


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__doc and __gone (numbers of the first lines of repeated pairs) of every row that loses lines.

    Three steps, of which none shuffles the texts: count the rolling hashes, 8 bytes a line with map-side combine; read
    the texts again and keep the pairs whose hash recurs, by a filter of fixed size; group those by their bytes, again
    with map-side combine, and join each with its first place.
    """
    text = F.col(text_col)
    source = docs.where(F.contains(text, F.lit("\n"))).select(id_or_last(id_col).alias("rank"), document_key(id_col, text_col).alias("__doc"), _lines(text).alias("lines"))
    counted = source.select(F.explode(rolling_hashes(F.col("lines"))).alias("s")).groupBy(F.col("s.hash").alias("hash")).agg(F.count("*").alias("n"))
    chunk = lambda s: F.struct(s["at"].alias("at"), s["hash"].alias("hash"), F.concat_ws("\n", F.get("lines", s["at"]), F.get("lines", s["at"] + 1)).alias("chunk"))
    pairs = source.select("rank", "__doc", F.explode(F.transform(rolling_hashes(F.col("lines")), chunk)).alias("s")).select("rank", "__doc", "s.*")
    seeds = marked(pairs, F.col("hash"), bitmap(counted.where("n > 1"))).where("__set")
    seeds = written(seeds.select("rank", "__doc", "at", "chunk"), "line-seeds")

    place = F.struct("rank", "at")
    key = [F.unhex(F.md5("chunk")).alias("key"), F.xxhash64("chunk").alias("key2")]
    groups = seeds.select(*key, "chunk", place.alias("place")).groupBy("key", "key2", "chunk").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    # A place counts if an earlier one does not overlap it: in another document, or two lines before at least.
    after = lambda p: (p["rank"] > F.col("first.rank")) | (p["at"] > F.col("first.at") + 1)
    repeated = groups.where(after(F.col("last"))).select("key", "key2", "first")
    gone = seeds.select("rank", "__doc", "at", *key).join(repeated, ["key", "key2"]).where(after(F.struct("rank", "at")))
    return written(gone.groupBy("__doc").agg(F.array_sort(F.collect_set("at")).alias("__gone")), "line-repeats")


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs, the text without repeated chunks, and n_lines, n_chunks (removed) and n_removed_lines.

    Every run of two or more lines that stands earlier in the corpus goes whole, unless all its lines are blank; the
    first of all places, by id and line, keeps it. The earlier place may be in the same document if the two do not
    overlap. Only documents that lose lines are shuffled, by a filter of fixed size that lets all of them through. A
    null text stays null and has no lines; a null id comes after all others. Rows of one id count as one document: what
    they hold at the same line is no repeat. An empty table gives no rows. Names that docs and the operator share are
    the operator's.
    """
    text = F.col(text_col)
    kept_columns = [c for c in docs.columns if c not in (*OWN, *BITMAP_COLUMNS, "__doc", "__gone", "__cut")]
    gone = repeated_lines(docs, id_col, text_col)
    keyed = docs.select(*kept_columns, document_key(id_col, text_col).alias("__doc"))
    judged = marked(keyed, F.xxhash64("__doc"), bitmap(gone.select(F.xxhash64("__doc").alias("hash"))))
    zero = F.lit(0).cast("long")
    whole = F.struct(text.alias("text"), F.coalesce(F.size(_lines(text)).cast("long"), zero).alias("lines"), zero.alias("chunks"), zero.alias("removed"))

    def cut(lines):
        covered = F.array_union("__gone", F.transform("__gone", lambda i: i + 1))
        starts = F.filter("__gone", lambda i, k: (k == 0) | (F.get("__gone", k - 1) < i - 1))
        kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered), lambda i: F.get(lines, i))
        return F.struct(F.array_join(kept, "\n").alias("text"), F.size(lines).cast("long").alias("lines"), F.size(starts).cast("long").alias("chunks"), F.size(covered).cast("long").alias("removed"))

    changed = judged.where("__set").join(gone, "__doc", "left")
    changed = changed.withColumn("__cut", F.when(F.col("__gone").isNull(), whole).otherwise(let(_lines(text), cut)))
    same = judged.where(~F.col("__set")).withColumn("__cut", whole)
    out = lambda rows: rows.select(
        *[F.col("__cut.text").alias(c) if c == text_col else F.col(c) for c in kept_columns],
        F.col("__cut.lines").alias("n_lines"),
        F.col("__cut.chunks").alias("n_chunks"),
        F.col("__cut.removed").alias("n_removed_lines"),
    )
    return out(same).unionByName(out(changed))
