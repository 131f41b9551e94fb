"""Vectors of Arrow list columns as matrices; shared by the operators on whole numbers derived from embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGEST = 1 << 40  # whole numbers beyond this have no exact place in the sums


def whole_vectors(rows: DataFrame, factor: float, shift: int = 0) -> DataFrame:
    """``rows`` whose ``embedding`` is not null and holds numbers only, with ``x``: floor(factor * entry) + shift of each entry."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(factor)) + F.lit(shift).cast("long"))
    return rows.where(F.coalesce(finite, F.lit(False))).withColumn("x", whole)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of int64) for every length of the vectors of a column without nulls."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(values) and max(int(values.max()), -int(values.min())) > LARGEST:
        raise ValueError(f"an entry of a vector is beyond {LARGEST} after scaling")
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        yield size, rows, values[starts[rows][:, None] + np.arange(size)]


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1), kind))


def added_up(parts: DataFrame, keys: list[str], values: str) -> DataFrame:
    """(keys, at, value, n): the sum of the lists ``values`` and of ``n`` over the rows of each key, entry by entry."""
    each = parts.select(*keys, "n", F.posexplode(values).alias("at", "value"))
    return each.groupBy(*keys, "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))


def unknown_last(name: str) -> list[Column]:
    return [F.col(name).isNull(), F.col(name)]
