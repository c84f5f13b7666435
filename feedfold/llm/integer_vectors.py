"""Vectors as integers: each component times a scale, rounded down."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def largest(dim: int) -> int:
    """Components up to this one give squared distances and products of `dim` components that fit a long with room to spare."""
    return int((2**60 / dim) ** 0.5)


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of lists of `width` numbers each, as rows."""
    flat = pc.list_flatten(column)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.to_numpy(zero_copy_only=False)).reshape(-1, width)


def integer_vectors(vectors: DataFrame, scale: int, *more: str) -> DataFrame:
    """row, vec_id, dim, ints and more columns of the rows of vectors that take part.

    Vectors that are null or empty or hold null or non-finite components take no part, nor do those with a component beyond
    largest(dim), whose sums no long can hold. A row is told apart by `row`, so vec_ids may repeat or be null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                lens = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = pc.list_flatten(batch.column(2)).to_numpy(zero_copy_only=False).astype(float)
                with np.errstate(invalid="ignore", over="ignore"):
                    x = np.floor(flat * scale)
                bounds = np.array([largest(n) if n else 0 for n in lens])
                good = np.isfinite(x) & (np.abs(x) <= np.repeat(bounds, lens))
                bad = np.bincount(np.repeat(np.arange(len(lens)), lens)[~good], minlength=len(lens))
                ok = (lens > 0) & (bad == 0)
                ints = list_array(x[np.repeat(ok, lens)].astype(np.int64), lens[ok], pa.int64())
                held = batch.filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays(
                    [held.column(0), held.column(1), pa.array(lens[ok], pa.int32()), ints, *held.columns[3:]], names=["row", "vec_id", "dim", "ints", *more]
                )

    c = lambda n: F.col(f"`{n}`")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), c("vec_id").alias("vec_id"), c("embedding").cast("array<double>").alias("embedding"), *(c(m) for m in more))
    f = rows.schema.fields
    made = [f[0], f[1], T.StructField("dim", T.IntegerType()), T.StructField("ints", T.ArrayType(T.LongType())), *f[3:]]
    return rows.mapInArrow(run, T.StructType(made))
