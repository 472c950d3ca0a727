"""Tables in hash buckets, of which a batch rewrites only those that it touches.

Each table is a Parquet folder partitioned by `bucket`, a hash of its key. A batch writes the new content of the
touched buckets aside first; a row in `commits`, appended when all tables are written, makes it count; then Spark's
dynamic partition overwrite puts the buckets in place. A crash before the commit changes nothing, one after it is made
good by whoever opens the store next: putting the same buckets in place twice is the same as once.

The commit row also says up to which offset each topic partition is folded, so progress and tables move together and
neither a repeated batch nor a new checkpoint loses or repeats records. Where Delta or Iceberg is installed, the same
DataFrames feed its MERGE INTO instead.
"""

from collections import namedtuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arborflow.session import empty_table, remove

BUCKETS = 1024
COMMITS = "version bigint, buckets int, tables array<string>, progress array<struct<topic:string,partition:int,offset:bigint>>, applied boolean"
PROGRESS = "topic string, partition int, done bigint"

Change = namedtuple("Change", "rows key touched")  # new rows of the touched buckets, the table's key, the buckets


def bucket_of(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_buckets(keys: DataFrame, buckets: int) -> list[int]:
    """Buckets of the keys (one column); as many numbers as there are buckets at most."""
    (name,) = keys.columns
    return sorted(r[0] for r in keys.where(F.col(name).isNotNull()).select(bucket_of(F.col(name), buckets)).distinct().collect())


class Store:
    """The tables below a path; schemas and keys are given by name."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str], keys: dict[str, str], buckets: int = BUCKETS):
        self.spark, self.path, self.schemas, self.keys = spark, path, schemas, keys
        last = self._last_commit()
        self.version = None if last is None else last.version
        self.buckets = buckets if last is None else last.buckets  # a store keeps the number it began with
        self._progress = [] if last is None else [tuple(p) for p in last.progress]
        if last is not None and not last.applied:
            self._apply(last.version, last.tables)

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _last_commit(self):
        commits = self._commits()
        # The row that says a version is in place comes after the one that commits it.
        return None if commits is None else commits.orderBy(F.desc("version"), F.desc("applied")).first()

    def _record(self, version, tables, applied):
        row = [(version, self.buckets, tables, self._progress, applied)]
        self.spark.createDataFrame(row, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _folder(self, name):
        return f"{self.path}/tables/{name}"

    def _shape(self, name) -> StructType:
        return StructType.fromDDL(f"{self.schemas[name]}, bucket int")

    def read(self, only: dict[str, list[int]] | None = None) -> dict[str, DataFrame]:
        """The tables, or of each table the buckets given in `only`: other files are not opened."""
        out = {}
        for name, schema in self.schemas.items():
            chosen = None if only is None else only.get(name)
            try:
                rows = None if chosen == [] else self.spark.read.schema(self._shape(name)).parquet(self._folder(name))
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = None
            if rows is None:
                out[name] = empty_table(self.spark, schema)
                continue
            rows = rows.where(F.col(self.keys[name]).isNotNull())  # a bucket's own row, see _staged
            out[name] = (rows if chosen is None else rows.where(F.col("bucket").isin(chosen))).drop("bucket")
        return out

    def new_records(self, records: DataFrame) -> DataFrame:
        """Records beyond the committed offsets of their topic partition; records without an offset are always new."""
        done = self.spark.createDataFrame(self._progress, PROGRESS)  # one row per topic partition
        fresh = F.col("done").isNull() | F.col("offset").isNull() | (F.col("offset") > F.col("done"))
        return records.join(done, ["topic", "partition"], "left").where(fresh).select(*records.columns)

    def _staged(self, name, change: Change, version):
        """Rows by bucket, and one row without key in each touched bucket: what becomes empty is overwritten as well."""
        marks = self.spark.createDataFrame([(b,) for b in change.touched], "bucket int")
        rows = change.rows.withColumn("bucket", bucket_of(F.col(change.key), self.buckets)).where(F.col("bucket").isin(change.touched))
        both = rows.unionByName(marks, allowMissingColumns=True)
        both.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/staged/version={version}/{name}")

    def _apply(self, version, tables):
        for name in tables:
            rows = self.spark.read.schema(self._shape(name)).parquet(f"{self.path}/staged/version={version}/{name}")
            writer = rows.repartition("bucket").write.partitionBy("bucket").mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").parquet(self._folder(name))
        self._record(version, tables, True)
        remove(self.spark, f"{self.path}/staged/version={version}")

    def commit(self, changes: dict[str, Change], records: DataFrame | None = None) -> int:
        """Write the changes as the next version, with the offsets of `records` as progress."""
        version = 0 if self.version is None else self.version + 1
        changes = {name: change for name, change in changes.items() if change.touched}
        for name, change in changes.items():
            self._staged(name, change, version)
        if records is not None:
            reached = records.where(F.col("offset").isNotNull()).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
            progress = {p[:2]: p[2] for p in self._progress} | {(r.topic, r.partition): r.offset for r in reached.collect()}
            self._progress = [(*place, offset) for place, offset in sorted(progress.items())]
        self.version = version
        self._record(version, list(changes), False)
        self._apply(version, list(changes))
        return version

