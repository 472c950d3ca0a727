"""Discovery: which files are in scope, why the others are not, and checks on the manifest."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborflow.constants import ALL_PYTHON, NOT_INCLUDED_REASON, SCOPES, Scope
from arborflow.functions.paths import matches_glob

MANIFEST_COLUMNS = [
    "repository_id",
    "commit_sha",
    "file_path",
    "size_bytes",
    "content_sha256",
    "scope",
    "included",
    "exclusion_reason",
]
# Rows of one ordered run checked together; a run's edges are compared in further, far smaller passes.
RUN_LENGTH = 100_000
FAN = 10_000  # runs, and runs of runs, looked at together


def resolved(name: str, scopes=SCOPES) -> Scope:
    """A scope with each open part taken from its nearest ancestor that states it; an unknown one takes all Python files."""
    lineage = []
    while name in scopes and scopes[name] not in lineage:
        lineage.append(scopes[name])
        name = lineage[-1].parent
    lineage.append(Scope(include=ALL_PYTHON, exclude=()))
    stated = (next((part for part in parts if part is not None), None) for parts in zip(*lineage))
    return Scope(*stated)._replace(parent=None)


def is_included(path: Column, scope: Scope) -> Column:
    return reduce(or_, [matches_glob(path, pattern) for pattern in scope.include], F.lit(False))


def exclusion_reason(path: Column, scope: Scope) -> Column:
    """Reason of the first matching rule, NULL if none matches."""
    return F.coalesce(*[F.when(matches_glob(path, pattern), reason) for pattern, reason in scope.exclude], F.lit(None).cast("string"))


def selected_files(files: DataFrame, scope: Scope, path_col="file_path") -> DataFrame:
    """Files in scope; a scope with a file limit keeps its first files by path."""
    path = F.col(path_col)
    selected = files.where(is_included(path, scope) & exclusion_reason(path, scope).isNull())
    return selected if scope.max_files is None else selected.orderBy(path_col).limit(scope.max_files)


def apply_scope(files: DataFrame, scope: Scope, path_col="file_path") -> DataFrame:
    """Add `included` and `exclusion_reason`: pure projections, unless the scope has a file limit."""
    path = F.col(path_col)
    reason = exclusion_reason(path, scope)
    if scope.max_files is None:
        included = is_included(path, scope) & reason.isNull()
        marked = files.withColumn("included", included)
    else:
        first = selected_files(files, scope, path_col).select(path_col, F.lit(True).alias("included"))
        marked = files.join(first, path_col, "left").withColumn("included", F.coalesce("included", F.lit(False)))
    why = F.when(~F.col("included"), F.coalesce(reason, F.lit(NOT_INCLUDED_REASON)))
    return marked.withColumn("exclusion_reason", why)


def build_manifest(files: DataFrame, repository_id: str, commit_sha: str, scope="final", scopes=SCOPES) -> DataFrame:
    """One row per discovered file; `files` has file_path, size_bytes and content_sha256."""
    return (
        apply_scope(files, resolved(scope, scopes))
        .withColumn("repository_id", F.lit(repository_id))
        .withColumn("commit_sha", F.lit(commit_sha))
        .withColumn("scope", F.lit(scope))
        .select(MANIFEST_COLUMNS)
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.orderBy("file_path").write.mode("overwrite").json(path)


def out_of_order(rows: DataFrame, value: Column, position: Column, keys=(), run_length=RUN_LENGTH, fan=FAN) -> DataFrame:
    """Count, per key, of rows whose value is not above that of the row before it.

    One key may hold most of the rows, so order is checked in levels: inside runs of consecutive positions, which
    spread over the cluster, then between the last row of a run and the first of the next, inside runs of runs, and
    once more; what is left for one task is a row per run_length * fan * fan positions.
    """
    keys = list(keys)
    value, position = value.alias("_first"), position.cast("bigint").alias("_at")
    level = rows.select(*keys, value, position).withColumns({"_last": F.col("_first"), "_bad": F.lit(0).cast("bigint")})
    jump = lambda window: F.col("_bad") + F.when(F.lag("_last").over(window) >= F.col("_first"), 1).otherwise(0)
    for width in (run_length, fan, fan):
        level = level.withColumn("_run", F.floor(F.col("_at") / width))
        inside = Window.partitionBy(*keys, "_run").orderBy("_at")
        level = (
            level.withColumn("_bad", jump(inside))
            .groupBy(*keys, "_run")
            .agg(F.sum("_bad").alias("_bad"), F.min_by("_first", "_at").alias("_first"), F.max_by("_last", "_at").alias("_last"))
            .withColumnRenamed("_run", "_at")
        )
    checked = level.withColumn("_bad", jump(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_at")))
    return (checked.groupBy(*keys) if keys else checked.groupBy()).agg(
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("out_of_order")
    )


def path_contract(files: DataFrame, path_col="file_path", position_col=None) -> DataFrame:
    """One row of violation counts: duplicate, foreign suffix, backslash, parent reference (and order)."""
    path = F.col(path_col)
    checks = files.groupBy(path_col).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("paths"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(~path.endswith(".py"), F.col("count"))), F.lit(0)).alias("not_python"),
        F.coalesce(F.sum(F.when(path.contains("\\"), F.col("count"))), F.lit(0)).alias("backslashes"),
        F.coalesce(F.sum(F.when(path.startswith("../"), F.col("count"))), F.lit(0)).alias("outside"),
    )
    if not position_col:
        return checks
    none = F.lit(0).cast("bigint")
    order = out_of_order(files, path, F.col(position_col)).select(*[none.alias(c) for c in checks.columns], "out_of_order")
    both = checks.withColumn("out_of_order", none).unionByName(order)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def assert_path_contract(files: DataFrame, path_col="file_path") -> None:
    found = path_contract(files, path_col).first().asDict()
    broken = {name: count for name, count in found.items() if name != "paths" and count}
    if broken:
        raise ValueError(f"Path contract violated: {broken}")


def manifest_sizes(manifest: DataFrame) -> DataFrame:
    """Size statistics of the included files."""
    return manifest.where("included").agg(
        F.count("*").alias("files"),
        F.min("size_bytes").alias("min_size"),
        F.max("size_bytes").alias("max_size"),
        F.avg("size_bytes").alias("mean_size"),
        F.median("size_bytes").alias("median_size"),
    )


def files_by_directory(manifest: DataFrame) -> DataFrame:
    top = F.substring_index("file_path", "/", 1)
    return manifest.groupBy(top.alias("directory")).agg(F.count("*").alias("files"))


def files_by_reason(manifest: DataFrame) -> DataFrame:
    return manifest.where("not included").groupBy("exclusion_reason").agg(F.count("*").alias("files"))


def manifest_problems(manifest: DataFrame, repository_id: str, commit_sha: str) -> DataFrame:
    """One row: rows with a foreign repository or commit, a foreign suffix or no content hash."""
    bad = {
        "wrong_repository": ~F.col("repository_id").eqNullSafe(repository_id),
        "wrong_commit": ~F.col("commit_sha").eqNullSafe(commit_sha),
        "not_python": ~F.col("file_path").endswith(".py"),
        "no_hash": F.coalesce("content_sha256", F.lit("")) == "",
    }
    return manifest.agg(*[F.count_if(test).alias(name) for name, test in bad.items()])


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, counted copy by copy, with the side they are on. Empty means equal.

    One aggregation over the union instead of two exceptAll shuffles.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_n")).unionByName(right.select(*columns, F.lit(-1).alias("_n")))
    return (
        both.groupBy(columns)
        .agg(F.sum("_n").alias("surplus"))
        .where("surplus <> 0")
        .select(*columns, F.when(F.col("surplus") > 0, "left").otherwise("right").alias("only_in"), F.abs("surplus").alias("copies"))
    )


def missing_from(part: DataFrame, whole: DataFrame, key="file_path") -> DataFrame:
    """Rows of `part` whose key `whole` lacks; empty when `part` is a subset."""
    return part.join(whole.select(key), key, "left_anti")


def _hashed(column: str, kind) -> list[Column]:
    """What the row hash takes of a column: its value, and whether it is there, as hashes pass over nulls."""
    value = F.col(f"`{column}`")
    if isinstance(kind, T.MapType):
        value = F.array_sort(F.map_entries(value))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # no negative zero
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    return [F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}) if nested else value, value.isNull()]


def multiset_digest(rows: DataFrame, group=()) -> DataFrame:
    """One row (per group): `rows` and a `digest` of all rows as a multiset, whatever their order, in one aggregate.

    Each row has a hash of 128 bits; the digest is of their number, sums and exclusive ors, so repeated rows count and
    two halves can be added up. Columns go in by name. Equal tables have equal digests; unequal ones differ but for a
    chance that no table of real size reaches.
    """
    group = list(group)
    parts = [p for f in sorted(rows.schema.fields, key=lambda f: f.name) if f.name not in group for p in _hashed(f.name, f.dataType)]
    hashed = rows.select(*group, *[F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2)])
    sums = [F.sum(F.col(h).cast("decimal(20,0)")).alias(f"{h}_sum") for h in ("_h1", "_h2")]
    xors = [F.bit_xor(h).alias(f"{h}_xor") for h in ("_h1", "_h2")]
    grouped = (hashed.groupBy(*group) if group else hashed.groupBy()).agg(F.count("*").alias("rows"), *sums, *xors)
    told = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in grouped.columns if c not in group])
    return grouped.select(*group, "rows", F.sha2(told, 256).alias("digest"))


def same_runs(rows: DataFrame, run: str) -> DataFrame:
    """run, rows and same_as: the smallest run with just the same rows, as often each. One aggregate over the rows."""
    digests = multiset_digest(rows, [run])
    first = digests.groupBy("rows", "digest").agg(F.min(run).alias("same_as"))
    return digests.join(first, ["rows", "digest"]).select(run, "rows", "same_as")


def run_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """set_difference of two runs, but only if their digests differ: equal runs are told by one aggregate each."""
    one, other = (multiset_digest(side).first() for side in (left, right))
    return set_difference(left, right).limit(0) if one == other else set_difference(left, right)
