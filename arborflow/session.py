"""Session defaults and the shared work folder."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(app_name="arborflow", master=None, **conf):
    """A session with the settings the jobs rely on; cluster settings given by spark-submit win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: list = []  # removed when the process ends
_open = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Without one, a temporary folder on a local master, and an error on any other."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        _local_folders.append(tempfile.TemporaryDirectory(prefix="arborflow-", ignore_cleanup_errors=True))
        folder = _local_folders[-1].name
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once into the shared folder and read it back: one computation, short lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in getattr(_open, "scopes", [])[-1:]:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact_files(spark: SparkSession) -> None:
    """Parquet files that this session writes are packed by zstd, unless its owner or the writer names a codec.

    Snappy, Spark's default, leaves hexadecimal digests as they are; zstd halves them.
    """
    codec = "spark.sql.parquet.compression.codec"
    if spark.conf.get(codec, None) is None:
        spark.conf.set(codec, "zstd")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def work_tables(spark: SparkSession):
    """Removes, at its end, what `written` wrote inside it in this thread; results have to be stored by then."""
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    _open.scopes.append([])
    try:
        yield
    finally:
        for path in _open.scopes.pop():
            remove(spark, path)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows that the optimizer knows to be empty, so joins with it vanish from the plan."""
    fields = StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
