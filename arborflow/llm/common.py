"""Helpers shared by the operators: word hashes, compact integer blobs, streaming over sorted groups."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1  # stands for a null id: no id is larger
FLUSH_WORDS = 2_000_000  # words that a task holds at a time, whole texts; results do not depend on it

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# A-Z become a-z; what is neither digit, letter nor beyond ASCII separates words.
ITEM_WORDS = bytes(LOWER[c] if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


_owner = None
_caches: dict = {}  # of this Python worker, which runs tasks of one operator after the other


def worker_cache(owner: str, key=None, make=None):
    """The worker's cache of an operator, kept over its tasks; what other operators kept is let go, and its memory freed."""
    global _owner
    if owner != _owner:
        _owner = owner
        _caches.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)  # what Python and numpy freed, which the C library (where it is glibc) keeps otherwise
    if make is None:
        return None
    kept = _caches.get(owner)
    if kept is None or kept[0] != key:
        _caches[owner] = kept = (key, make())
    return kept[1]


def id_or_last(name: str):
    """An id column as long, a null as the largest value."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def word_codes(words: list) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all its bits (finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def gram_hashes(codes: np.ndarray, at: np.ndarray, size: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of the `size` consecutive word codes from each position in `at`."""
    total = np.zeros(len(at), np.uint64)
    for step in range(size):
        total = total * np.uint64(seed) + codes[at + step]
    return mix(total + np.uint64(size))


def texts_of(batch: pa.RecordBatch, name: str) -> list:
    """UTF-8 bytes of a string column; null stays None."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def blob(values, width: int) -> bytes:
    """Non-negative integers below 256**width as one compressed value, byte by byte of equal weight."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def unblob(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").copy()


def group_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """First position of each run of equal values."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    changed = np.zeros(len(sorted_columns[0]) - 1, bool)
    for column in sorted_columns:
        changed |= column[1:] != column[:-1]
    return np.concatenate(([0], np.flatnonzero(changed) + 1))


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of the first key in one partition, ordered by the keys."""
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


def by_key(batches, key: str):
    """Rows of clustered batches as (key, iterator over the key's rows as dicts), one key after the other."""
    import itertools

    def rows():
        for batch in batches:
            yield from batch.to_pylist()

    return itertools.groupby(rows(), key=lambda row: row[key])


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
