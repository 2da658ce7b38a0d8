"""Vectors of integers: what the clustering and the code compression share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
#: Larger components (in absolute value, after scaling) have squared distances that no long holds; such vectors take no part.
LARGEST = 2**27
#: Up to this size, products of components summed over some thousand dimensions are whole numbers that a double holds exactly.
EXACT_IN_DOUBLE = 2**20
#: Rows handled at once in a task.
ROWS = 65_536


def integer_vectors(vectors: DataFrame, *carry: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<int>, carried columns): every component becomes floor(scale * component), taken as a double.

    Vectors that are null, empty, hold null or non-finite components or components beyond ``LARGEST`` take no part."""
    own = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"), *carry)
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(LARGEST / scale))
    own = own.where(F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: F.coalesce(good(v), F.lit(False))))
    return own.withColumn("x", F.transform("x", lambda v: F.floor(v * float(scale)).cast("int")))


def matrix(column) -> np.ndarray:
    """(rows, components) of a list column whose lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64) if len(column) else np.zeros((0, 0), np.int64)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column with one list of ``kind`` for each row of a matrix."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel(), kind))


def gathered(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.Table]:
    """The same rows in tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows of x, rows of c)."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT_IN_DOUBLE:
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - c[None, :, j]) ** 2
    return out


def group_sums(x: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in each group, and componentwise sums."""
    order = np.argsort(group, kind="stable")
    begins = np.searchsorted(group[order], np.arange(groups + 1))
    counts = np.diff(begins)
    total = np.zeros((groups, x.shape[1]), np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        total[full] = np.add.reduceat(x[order], begins[full], axis=0)
    return counts, total


def sums_of(column: str, length: int) -> list:
    """Aggregates t0, t1, ... that add a list column componentwise; decimals, since sums of longs may not fit a long."""
    return [F.sum(F.col(column)[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(length)]


def long_or_null(value: int) -> int | None:
    return value if -(2**63) <= value < 2**63 else None
