"""Vectors as rows: which take part, and equal ones as one class."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def usable(vector: Column) -> Column:
    """Not NULL, not empty, not all zero, no NULL and only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def keyed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, h1, h2, vector array<double>, used)``: two hashes stand for the vector."""
    vector = F.col(vector_col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).select(
        "vec_id", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("vector"), "vector").alias("h2"), "vector",
        (usable(F.col("vector")) & F.col("vec_id").isNotNull()).alias("used"))


def sample(classes: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """At most ``rows`` vectors drawn by their hash, as one matrix per dimension."""
    drawn = classes.select("h1", "vector").orderBy("h1").limit(rows).select("vector").collect()
    by: dict[int, list] = {}
    for r in drawn:
        by.setdefault(len(r["vector"]), []).append(r["vector"])
    return {d: np.array(v, dtype=np.float64) for d, v in by.items()}


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def by_dimension(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    """``(dimension, row numbers)`` of a list column."""
    size = np.asarray(column.value_lengths())
    return [(int(d), np.flatnonzero(size == d)) for d in np.unique(size)]


