"""Integer vectors, shared by the vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def integer_vectors(df: DataFrame, vector: str, scale: int, limit: float, **keep: Column) -> DataFrame:
    """Columns ``keep``, then v (array of long: floor(scale * x) of every component x as a double) and n2 (its squared
    length as a double). Rows whose vector is null, holds null or non-finite components, or is longer than the
    square root of ``limit`` (products of such vectors would not fit a long) are left out."""
    fixed = df.select(*(c.alias(n) for n, c in keep.items()), F.col(vector).cast("array<double>").alias("v"))
    fixed = fixed.where(F.col("v").isNotNull())
    names = [*keep, "v", "n2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(b.num_columns - 1)
            x = column.flatten().to_numpy(zero_copy_only=False)  # nulls come as NaN
            size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            with np.errstate(over="ignore", invalid="ignore"):
                y = np.floor(x * float(scale))
                n2 = np.bincount(row, weights=np.where(np.isfinite(x), y * y, np.inf), minlength=len(size)).astype(float)
            fits = n2 <= limit
            whole = np.where(np.repeat(fits, size), y, 0).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole))
            columns = [*b.columns[:-1], lists, pa.array(n2)]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(fits))

    kinds = ", ".join(f"`{n}` {t}" for n, t in fixed.dtypes[:-1])
    return fixed.mapInArrow(run, f"{kinds}, v array<bigint>, n2 double")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """One row per list, filled up with zeros to ``width`` components."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out
