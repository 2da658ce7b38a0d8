"""Helpers shared by the operators of this folder: shared-folder tables and Arrow text batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmetrics.session import fresh_path

#: Text bytes handled at once inside a task. Arrow batches above it are sliced, so the
#: working arrays of a task do not depend on how long the documents are.
SLICE_BYTES = 2 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; a lost executor re-reads the files."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows: those whose ``key`` has the smallest hash, whatever the order and partitioning.

    A count comes first. Of a larger frame only the rows below a hash bound (about four times
    ``rows``) go on to the sort, so what meets in its last task does not grow with the frame.
    """
    total = df.count()
    h = F.xxhash64(key)
    if total > 4 * rows:
        df = df.where(h < F.lit(int(4 * rows / total * 2**64) - 2**63))
    return df.orderBy(h, key).limit(rows)


def text_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def byte_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_parts(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            end = max(end, start + 1)
            yield batch.slice(start, end - start)
            start = end
    release()


def release() -> None:
    """Give memory that is free back to the system: a worker outlives its task, and the next one may be another operator's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without this call
        ctypes.CDLL(None).malloc_trim(0)


def map_large_arrays() -> None:
    """Arrays of a megabyte or more are mapped, each by itself, and go back to the system as soon as they are freed.

    By default the C library raises that size with every large array that is freed; later ones then come from
    its heap, which small objects between them keep from shrinking: a worker grew from stage to stage."""
    mmap_threshold, arena_max = -3, -8
    with contextlib.suppress(OSError, AttributeError):
        library = ctypes.CDLL(None)
        library.mallopt(mmap_threshold, 1 << 20)
        library.mallopt(arena_max, 2)
    pa.set_memory_pool(pa.system_memory_pool())  # Arrow's own pool keeps what was freed, too


map_large_arrays()


def binary_array(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary array over bytes that are there already; nothing is copied."""
    off = np.ascontiguousarray(offsets, np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(raw))]
    )


def count_in(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often ``mask`` is true between neighbouring offsets."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), offsets))


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, drop: Callable[[], None]) -> None:
    """Announce what operator ``name`` remembers in this Python worker; ``drop`` forgets it.

    Workers outlive tasks and stages. When another operator's turn comes, the earlier one's memory goes."""
    if name not in _HELD:
        for other in list(_HELD.values()):
            other()
        _HELD.clear()
        release()
        _HELD[name] = drop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every (start, length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
