"""Edge events that name other endpoints than the living edge has when they arrive.

An edge seen with one endpoint pair has no such event. Of the others, histories of up to SHORT_HISTORY events are
folded inside one row each. A longer history is never replayed: what an accepted upsert leaves behind does not depend
on what was there before it, so each upsert has a fixed successor, and following successors from the first is
pointer doubling, which composes the steps in a logarithmic number of joins:

* an upsert's pair lives until a delete of the living generation comes that does not name another pair; until then
  only upserts of the same pair are accepted, so upserts of one pair up to such a delete are one life;
* a life is followed by the first upsert, of any pair, after its last delete.

One thing is not fixed: a delete that names endpoints closes its generation only if no other pair lives then. They are
taken to close it first; what follows says which of them do, and that is repeated until it agrees with itself.
Each round puts the earliest wrong one right at least, and all that it decides alone.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.session import written

SHORT_HISTORY = 512
_EVENT = ["seq", "is_delete", "source_id", "target_id", "generation_id", "entombed", "refused"]


def neighbour(rows: DataFrame, keys: list[str], value: str, run_length: int, after=True) -> DataFrame:
    """rows with `value` replaced by the nearest one that is not null after (or before) each row of the same keys.

    Order is by seq. It is looked for among consecutive records first, then in one row per run of them, so no task
    holds a key's whole history.
    """
    way = (lambda c: F.col(c).desc()) if after else F.col
    rows = rows.withColumn("_run", F.floor(F.col("seq") / run_length))
    inside = Window.partitionBy(*keys, "_run").orderBy(way("seq")).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy(way("_run")).rowsBetween(Window.unboundedPreceding, -1)
    nearest = (F.min_by if after else F.max_by)(value, F.when(F.col(value).isNotNull(), F.col("seq")))
    runs = rows.groupBy(*keys, "_run").agg(nearest.alias("_own")).withColumn("_far", F.last("_own", ignorenulls=True).over(across))
    found = rows.withColumn("_near", F.last(value, ignorenulls=True).over(inside)).join(runs.drop("_own").where("_far IS NOT NULL"), [*keys, "_run"], "left")
    return found.withColumn(value, F.coalesce("_near", "_far")).drop("_run", "_near", "_far")


def _differs(named: Column, living: Column) -> Column:
    return named.isNotNull() & (named != living)


def _folded(events: Column) -> Column:
    """seq of the dead letters of one sorted history: a fold over (living edge, closed generations, dead letters)."""
    none = F.lit(None).cast("string")
    strings, numbers = F.array().cast("array<string>"), F.array().cast("array<bigint>")

    def state(source, target, generation, closed, dead):
        return F.struct(source.alias("s"), target.alias("t"), generation.alias("g"), closed.alias("closed"), dead.alias("dead"))

    def step(a, e):
        foreign = F.coalesce(a["s"].isNotNull() & (_differs(e["source_id"], a["s"]) | _differs(e["target_id"], a["t"])), F.lit(False))
        hit = F.coalesce(a["g"] == e["generation_id"], F.lit(False))
        left = lambda c: F.when(~hit, a[c])
        fresh = ~e["refused"] & ~F.array_contains(a["closed"], e["generation_id"])
        return (
            F.when(foreign, state(a["s"], a["t"], a["g"], a["closed"], F.array_append(a["dead"], e["seq"])))
            .when(e["entombed"], a)
            .when(e["is_delete"], state(left("s"), left("t"), left("g"), F.array_union(a["closed"], F.array(e["generation_id"])), a["dead"]))
            .when(fresh, state(e["source_id"], e["target_id"], e["generation_id"], a["closed"], a["dead"]))
            .otherwise(a)
        )

    return F.aggregate(events, state(none, none, none, strings, numbers), step, lambda a: a["dead"])


def _short(histories: DataFrame) -> DataFrame:
    folded = histories.groupBy("edge_id").agg(_folded(F.array_sort(F.collect_list(F.struct(*_EVENT)))).alias("dead"))
    return folded.select("edge_id", F.explode("dead").alias("seq"))


def _next_named_delete(upserts: DataFrame, named: DataFrame, run_length: int) -> DataFrame:
    """(edge_id, seq, hit): the first delete after each upsert that names its generation and one or both of its ends."""
    keys = ["edge_id", "generation_id", "by", "s", "t"]

    def rows(events, by, value):
        s, t = (F.col(c) if n in by else F.lit("") for c, n in (("source_id", "s"), ("target_id", "t")))
        return events.select("edge_id", "generation_id", F.lit(by).alias("by"), s.alias("s"), t.alias("t"), "seq", value.alias("hit"))

    empty = F.lit(None).cast("bigint")
    of = {"st": "source_id IS NOT NULL AND target_id IS NOT NULL", "s": "target_id IS NULL", "t": "source_id IS NULL"}
    asked = upserts.join(named.select("edge_id", "generation_id").distinct(), ["edge_id", "generation_id"], "left_semi")
    both = None
    for by, where in of.items():
        part = rows(asked, by, empty).withColumn("asks", F.lit(True)).unionByName(rows(named.where(where), by, F.col("seq")).withColumn("asks", F.lit(False)))
        both = part if both is None else both.unionByName(part)
    found = neighbour(both, keys, "hit", run_length).where("asks AND hit IS NOT NULL")
    return found.groupBy("edge_id", "seq").agg(F.min("hit").alias("hit"))


def _lives(opened: DataFrame, deletes_of: DataFrame, named: DataFrame, run_length: int) -> DataFrame:
    """The lives that follow each other from each edge's first upsert: edge_id, entry, source_id, target_id, death."""
    pair = ["edge_id", "source_id", "target_id"]
    rows = opened.join(deletes_of, ["edge_id", "generation_id"], "left").join(_next_named_delete(opened, named, run_length), ["edge_id", "seq"], "left")
    rows = rows.select(*pair, "seq", F.least("free_at", "hit").alias("death"), F.col("seq").alias("following"))
    rows = neighbour(rows, pair, "following", run_length)
    ends = F.col("following").isNull() | (F.col("death") < F.col("following"))
    rows = rows.withColumn("last", F.when(ends, F.struct(F.col("seq").alias("id"), "death")))
    own = F.col("last")
    rows = neighbour(rows.withColumn("life", own), pair, "life", run_length).withColumn("life", F.coalesce(own, "life"))
    rows = written(rows.select(*pair, "seq", "life.id", "life.death", own.isNotNull().alias("is_last")), "edge-lives")

    entry = F.struct(F.col("seq").alias("entry"), F.col("id").alias("life"))
    deaths = rows.where("is_last AND death IS NOT NULL").select("edge_id", F.col("death").alias("seq"), F.lit(None).cast("struct<entry:bigint,life:bigint>").alias("to"), "id")
    places = rows.select("edge_id", "seq", entry.alias("to"), F.lit(None).cast("bigint").alias("id")).unionByName(deaths)
    jumps = neighbour(places, ["edge_id"], "to", run_length).where("id IS NOT NULL AND to IS NOT NULL")
    jumps = written(jumps.select("edge_id", "id", F.col("to.entry").alias("to_entry"), F.col("to.life").alias("to_id")), "edge-jumps")
    first = rows.groupBy("edge_id").agg(F.min(entry).alias("to"))
    reached = first.select("edge_id", F.col("to.entry").alias("entry"), F.col("to.life").alias("id"))
    while not jumps.isEmpty():
        further = reached.join(jumps, ["edge_id", "id"]).select("edge_id", F.col("to_entry").alias("entry"), F.col("to_id").alias("id"))
        reached = written(reached.unionByName(further), "edge-reached")
        twice = jumps.select("edge_id", F.col("id").alias("_from"), F.col("to_id").alias("id"))
        jumps = written(twice.join(jumps, ["edge_id", "id"]).select("edge_id", F.col("_from").alias("id"), "to_entry", "to_id"), "edge-jumps")
    return reached.join(rows.where("is_last").select(*pair, "id", "death"), ["edge_id", "id"]).select("entry", *pair, "death")


def _long(history: DataFrame, run_length: int) -> DataFrame:
    history = written(history, "edge-histories")
    upserts = history.where("NOT is_delete AND NOT entombed AND NOT refused").select("edge_id", "source_id", "target_id", "generation_id", "seq")
    deletes = history.where("is_delete AND NOT entombed")
    generation = ["edge_id", "generation_id"]
    named = deletes.where("source_id IS NOT NULL OR target_id IS NOT NULL")
    free = deletes.where("source_id IS NULL AND target_id IS NULL").groupBy(*generation).agg(F.min("seq").alias("free_at"))
    free = written(free, "edge-free-deletes")

    def closings(effective):
        both = free.select(*generation, F.col("free_at").alias("closed_at")).unionByName(effective.select(*generation, F.col("seq").alias("closed_at")))
        return written(both.groupBy(*generation).agg(F.min("closed_at").alias("closed_at")), "edge-closings")

    closed = closings(named)
    while True:
        opened = upserts.join(closed, generation, "left").where("closed_at IS NULL OR closed_at > seq").drop("closed_at")
        lives = written(_lives(opened, free, named, run_length), "edge-path")
        living = F.struct(F.col("source_id").alias("s"), F.col("target_id").alias("t"))
        gone = F.lit(None).cast("string")
        marks = lives.select("edge_id", F.col("entry").alias("seq"), living.alias("living")).unionByName(
            lives.where("death IS NOT NULL").select("edge_id", F.col("death").alias("seq"), F.struct(gone.alias("s"), gone.alias("t")).alias("living"))
        )
        seen = neighbour(history.join(marks, ["edge_id", "seq"], "left"), ["edge_id"], "living", run_length, after=False)
        foreign = F.col("living.s").isNotNull() & (_differs(F.col("source_id"), F.col("living.s")) | _differs(F.col("target_id"), F.col("living.t")))
        judged = written(seen.withColumn("foreign", F.coalesce(foreign, F.lit(False))).drop("living"), "edge-judged")
        effective = judged.where("is_delete AND NOT entombed AND NOT foreign AND (source_id IS NOT NULL OR target_id IS NOT NULL)")
        now = closings(effective)
        columns = [*generation, "closed_at"]
        if now.join(closed, columns, "left_anti").isEmpty() and closed.join(now, columns, "left_anti").isEmpty():
            return judged.where("foreign").select("edge_id", "seq")
        closed = now


def foreign_endpoints(rows: DataFrame, edge_tombstones: DataFrame, run_length: int, short_history: int | None = None) -> DataFrame:
    """(edge_id, seq) of events that name other endpoints than the living edge has at that moment.

    rows: edge_id, seq, is_delete, source_id, target_id, generation_id, entombed. A generation with a tombstone cannot
    come to life again. Histories over `short_history` events go the distributed way; results do not depend on it.
    """
    short_history = SHORT_HISTORY if short_history is None else short_history
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("source_id", "target_id") for f in (F.min, F.max)]
    mixed = rows.groupBy("edge_id").agg(F.count("*").alias("events"), *ends)
    mixed = mixed.where("min_source_id <> max_source_id OR min_target_id <> max_target_id").select("edge_id", (F.col("events") > short_history).alias("long"))
    mixed = written(mixed, "edges-mixed")
    refused = edge_tombstones.select(F.col("id").alias("edge_id"), "generation_id", F.lit(True).alias("refused")).distinct()
    history = rows.join(mixed, "edge_id").join(refused, ["edge_id", "generation_id"], "left")
    history = history.select("edge_id", *[F.col(c) for c in _EVENT if c != "refused"], F.coalesce("refused", F.lit(False)).alias("refused"), "long")
    dead = _short(history.where("NOT long"))
    return dead if mixed.where("long").isEmpty() else dead.unionByName(_long(history.where("long").drop("long"), run_length))
