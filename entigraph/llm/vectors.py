"""What the vector operators share: which vectors take part, and copies as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def usable(v) -> np.ndarray | None:
    """The vector in double precision; None if it is null, empty, zero or holds null or non-finite components."""
    if v is None or not len(v) or any(x is None for x in v):
        return None
    a = np.array(v, np.float64)
    return a if np.isfinite(a).all() and a.any() else None


def prepared(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, v, fp): v the components as bytes of doubles, fp their digest; both null for vectors that take no part."""

    def read(batches):
        for batch in batches:
            raw = []
            column = batch.column(1)
            flat, size = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            if column.null_count == 0 and flat.null_count == 0 and len(size) and size.min() == size.max() > 0:
                a = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(size), -1)
                good = np.isfinite(a).all(axis=1) & a.any(axis=1)
                a = a + 0.0  # one zero
                raw = [a[i].tobytes() if good[i] else None for i in range(len(a))]
            else:
                raw = [None if (a := usable(v)) is None else (a + 0.0).tobytes() for v in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if r is None else len(r) // 8 for r in raw], pa.int32()), pa.array(raw, pa.binary()), pa.array([None if r is None else xxhash.xxh3_128_digest(r) for r in raw], pa.binary())], ["id", "dim", "v", "fp"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col)).mapInArrow(read, "id long, dim int, v binary, fp binary")


def distinct(rows: DataFrame, tmp: Scratch, name: str) -> DataFrame:
    """(id, copies, dim, v, fp): one row per distinct vector (of any dimension), with its smallest id."""
    own = rows.filter("v is not null and id is not null").groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumnRenamed("fp", "f")
    out = rows.join(own, (F.col("id") == F.col("rep")) & (F.col("fp") == F.col("f"))).select("id", "copies", "dim", "v", "fp")
    return tmp.save(out.dropDuplicates(["fp"]), name)


def matrix(raw) -> np.ndarray:
    raw = list(raw)
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 0))


def matrices(raw):
    """(dimension, places, matrix) for each dimension among the rows."""
    sizes = np.array([len(r) // 8 for r in raw], np.int64)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, matrix(raw[i] for i in at)
