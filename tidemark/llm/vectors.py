"""What the operators on vectors share: which rows take part, and numpy blocks of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_finite(vector: Column) -> Column:
    """No entry is NULL, NaN or infinite; an empty vector has none that is."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def finite_rows(rows: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """(vec_id long, vector array<double>, more) of the rows whose vector is there and finite."""
    picked = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), *more
    )
    return picked.where(F.col("vector").isNotNull() & is_finite(F.col("vector")))


def longest(rows: DataFrame, column: str = "vector") -> int:
    """Entries of the longest vector; 0 if there are no rows."""
    return rows.agg(F.max(F.size(column))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row per list; a list shorter than ``width`` has zeros behind it."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), values.dtype)
    out[np.repeat(np.arange(len(column)), sizes), np.concatenate([np.arange(s) for s in sizes])] = values
    return out


def in_blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a partition put together to tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def lists(rows: np.ndarray) -> pa.Array:
    """A list array with a list per row of the matrix."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))
