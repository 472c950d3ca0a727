"""Vector columns as rows of bytes, and their unit lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, also of components near the ends of the range."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def matrix(data: list, kind: str) -> np.ndarray:
    """Vectors of one length, given as bytes, as rows of doubles."""
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype("<f8") if data else np.zeros((0, 1))


def vector_rows(table: DataFrame, id_col: str, vector_col: str, **more: Column) -> tuple:
    """(rows, numpy type): vec_id, vector as bytes of its own width, further columns.

    The vector is null where it is null, empty or zero or holds null or non-finite components. Doubles stay doubles,
    floats stay floats, other numbers become doubles.
    """
    own = table.schema[vector_col].dataType
    narrow = isinstance(own, ArrayType) and isinstance(own.elementType, FloatType)
    kind = "<f4" if narrow else "<f8"
    source = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if narrow else "array<double>").alias("vector"), *[c.alias(n) for n, c in more.items()])

    def run(batches):
        for batch in batches:
            out = []
            for values in batch.column("vector").to_pylist():
                data = None
                if values and None not in values:
                    vector = np.array(values, kind) + np.zeros(1, kind)  # no negative zeros
                    data = vector.tobytes() if np.isfinite(vector).all() and vector.any() else None
                out.append(data)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary()), *batch.columns[2:]], names=batch.schema.names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return source.mapInArrow(run, "vec_id long, vector binary" + (f", {fields}" if fields else "")), kind
