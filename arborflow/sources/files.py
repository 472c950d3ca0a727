"""Source files of a working tree, listed, measured and read on the executors.

The `binaryFile` source skips hidden folders, `_`-prefixed names (`__init__.py`) and empty files, all of
which must be parsed, so these are small Arrow and pandas steps over rows of paths.
"""

import codecs
import hashlib
import os
import posixpath
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.constants import PRUNED_DIRECTORIES
from arborflow.functions import ids
from arborflow.session import written

LISTED = 20_000  # entries that a task lists before it hands back the folders it has not opened
_LISTED = pa.schema([("path", pa.string()), ("size_bytes", pa.int64()), ("is_file", pa.bool_())])
_BATCH_BYTES = 32 * 1024 * 1024
_CHUNK_BYTES = 1024 * 1024
_BREAK = re.compile("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")


class Tree:
    """A folder of any file system that Arrow knows: a plain path, or a URI such as hdfs://name/folder or s3://..."""

    def __init__(self, root: str):
        self.local = "://" not in root
        if self.local:
            self.top, self.system = os.path.realpath(root), fs.LocalFileSystem()
        else:
            self.system, path = fs.FileSystem.from_uri(root)
            self.top = posixpath.normpath(path)

    def path(self, relative: str) -> str:
        return self.top if relative in ("", ".") else f"{self.top}/{relative}"

    def entries(self, relative: str):
        """(name, is folder, size) of what lies in a folder. Links to folders are not followed; a dangling link has size 0."""
        if self.local:
            with os.scandir(self.path(relative)) as found:
                for entry in found:
                    if entry.is_dir(follow_symlinks=False):
                        yield entry.name, True, 0
                    elif not entry.is_dir():
                        yield entry.name, False, entry.stat().st_size if os.path.exists(entry.path) else 0
            return
        for info in self.system.get_file_info(fs.FileSelector(self.path(relative))):
            yield info.base_name, info.type == fs.FileType.Directory, info.size or 0

    def size(self, relative: str) -> int:
        info = self.system.get_file_info(self.path(relative))
        if info.type != fs.FileType.File:
            raise FileNotFoundError(info.path)
        return info.size

    def open(self, relative: str):
        return self.system.open_input_stream(self.path(relative))


def resolve_root(repository_root: str, source_root: str | None = None) -> str:
    """The folder to scan, relative to the repository; it must exist and lie inside it."""
    tree = Tree(repository_root)
    if tree.local:
        chosen = os.path.realpath(os.path.join(tree.top, source_root or "."))
    else:
        chosen = posixpath.normpath(posixpath.join(tree.top, source_root or "."))
    if chosen != tree.top and not chosen.startswith(tree.top.rstrip("/") + "/"):
        raise ValueError(f"{source_root} is outside the repository {tree.top}")
    if tree.system.get_file_info(chosen).type != fs.FileType.Directory:
        raise FileNotFoundError(f"no such folder: {chosen}")
    return chosen[len(tree.top) :].strip("/")


def scan_files(spark: SparkSession, repository_root: str, source_root=None, suffix=".py", prune=PRUNED_DIRECTORIES, budget=LISTED):
    """One row per matching file: file_path (relative, POSIX) and size_bytes.

    Folders are listed by tasks, in rounds: each task goes down from its folders until it has seen `budget` entries,
    and hands back the folders that it has not opened; the next round deals those out anew. So a deep chain is one
    task's walk, a wide tree spreads, and the driver sees no paths. What is found is dealt out over all cores, also
    where it lies in one folder.
    """
    pruned = frozenset(prune)
    cores = spark.sparkContext.defaultParallelism

    def listing(batches):
        tree, held = Tree(repository_root), {"path": [], "size_bytes": [], "is_file": []}

        def add(path, size, is_file):
            for name, value in zip(held, (path, size, is_file)):
                held[name].append(value)

        todo, seen = [], 0
        for batch in batches:
            todo += batch.column("folder").to_pylist()
        while todo and seen < budget:
            folder = todo.pop()
            for name, is_folder, size in tree.entries(folder):
                seen += 1
                path = f"{folder}/{name}" if folder else name
                if is_folder and name not in pruned:
                    todo.append(path)
                elif not is_folder and name.endswith(suffix):
                    add(path, size, True)
                if len(held["path"]) == 10_000:
                    yield pa.RecordBatch.from_pydict(held, schema=_LISTED)
                    held = {name: [] for name in held}
        for folder in todo:
            add(folder, 0, False)
        yield pa.RecordBatch.from_pydict(held, schema=_LISTED)

    frontier, found = spark.createDataFrame([(resolve_root(repository_root, source_root),)], "folder string"), None
    while True:
        listed = written(frontier.mapInArrow(listing, "path string, size_bytes bigint, is_file boolean"), "listed")
        files = listed.where("is_file").select(F.col("path").alias("file_path"), "size_bytes")
        found = files if found is None else found.unionByName(files)
        rest = listed.where("NOT is_file").count()
        if not rest:
            return found.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file_path")
        frontier = listed.where("NOT is_file").select(F.col("path").alias("folder")).repartition(max(cores, min(rest, rest // 64 + 4 * cores)))


def _too_large(path, size, limit) -> str:
    return f"{path}: {size} bytes, more than the limit of {limit}"


def _columns(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)


def _measured(tree: Tree, relative: str, limit):
    """size, line count and SHA-256 of one file, read in chunks; or the reason why it cannot be used."""
    try:
        size, digest, decoder = tree.size(relative), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")()
        if limit is not None and size > limit:
            return size, None, None, _too_large(relative, size, limit)
        breaks, open_line, carried = 0, False, ""
        with tree.open(relative) as handle:
            while chunk := handle.read(_CHUNK_BYTES):
                digest.update(chunk)
                text = carried + decoder.decode(chunk)
                carried = "\r" if text.endswith("\r") else ""
                text = text[: len(text) - len(carried)]
                breaks += sum(1 for _ in _BREAK.finditer(text))
                open_line = not _BREAK.fullmatch(text[-1]) if text else open_line
        decoder.decode(b"", final=True)
        return size, breaks + bool(carried) + (open_line and not carried), digest.hexdigest(), None
    except UnicodeDecodeError:
        return size, None, None, f"{relative}: not UTF-8 text"
    except OSError as problem:
        return None, None, None, f"{relative}: cannot be read ({type(problem).__name__})"


def measure_sources(paths: DataFrame, repository_root: str, max_bytes: int | None = None) -> DataFrame:
    """Add size_bytes, line_count, content_hash and read_error; files are read in chunks and none is held."""
    kept = paths.drop("size_bytes", "line_count", "content_hash", "read_error")

    added = (("size_bytes", pa.int64()), ("line_count", pa.int64()), ("content_hash", pa.string()), ("read_error", pa.string()))

    def measuring(batches):
        tree = Tree(repository_root)
        for batch in batches:
            found = [_measured(tree, path, max_bytes) for path in batch.column("file_path").to_pylist()]
            columns = [pa.array([row[i] for row in found], kind) for i, (_, kind) in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *[name for name, _ in added]])

    return kept.mapInArrow(measuring, f"{_columns(kept)}, size_bytes bigint, line_count bigint, content_hash string, read_error string")


def read_sources(paths: DataFrame, repository_root: str, max_bytes: int | None = None) -> DataFrame:
    """Add `content` (raw bytes) and `read_error`; exactly one of the two is set. No limit unless one is given."""
    schema = paths.drop("content", "read_error")

    def load(tree, relative):
        try:
            size = tree.size(relative)
            if max_bytes is not None and size > max_bytes:
                return None, _too_large(relative, size, max_bytes)
            with tree.open(relative) as handle:
                return handle.read(), None
        except OSError as problem:
            return None, f"{relative}: cannot be read ({type(problem).__name__})"

    def reading(batches):
        tree = Tree(repository_root)
        for batch in batches:
            start, held, loaded = 0, 0, []
            for position, relative in enumerate(batch["file_path"]):
                loaded.append(load(tree, relative))
                held += len(loaded[-1][0] or b"")
                if held >= _BATCH_BYTES or position == len(batch) - 1:
                    part = batch.iloc[start : position + 1].copy()
                    part["content"] = [c for c, _ in loaded]
                    part["read_error"] = [e for _, e in loaded]
                    yield part
                    start, held, loaded = position + 1, 0, []

    return check_sources(schema.mapInPandas(reading, f"{_columns(schema)}, content binary, read_error string"), max_bytes)


def check_sources(sources: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Strict read rules over a table with `file_path` and `content`: UTF-8, and the size limit if one is given."""
    given = F.col("read_error") if "read_error" in sources.columns else F.lit(None).cast("string")
    size = F.length("content")
    large = F.lit(False) if max_bytes is None else size > max_bytes
    error = F.coalesce(
        given,
        F.when(large, F.concat("file_path", F.lit(": "), size, F.lit(f" bytes, more than the limit of {max_bytes}"))).when(
            ~F.is_valid_utf8(F.col("content").cast("string")), F.concat("file_path", F.lit(": not UTF-8 text"))
        ),
    )
    return sources.withColumn("read_error", error).withColumn(
        "content", F.when(F.col("read_error").isNull(), F.col("content"))
    )


def identify(sources: DataFrame, repository_id) -> DataFrame:
    """Add file_id, and the content hash (unless it is there): '0' for a file that could not be read."""
    repository = repository_id if not isinstance(repository_id, str) else F.lit(repository_id)
    digest = F.col("content_hash") if "content_hash" in sources.columns else ids.content_hash(F.col("content"))
    return sources.withColumn("file_id", ids.file_id(repository, F.col("file_path"))).withColumn(
        "content_hash", F.when(F.col("read_error").isNotNull(), "0").otherwise(digest)
    )
