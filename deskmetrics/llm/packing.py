"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity`` tokens (only longer documents are cut).
How pieces fit together depends on their lengths alone, and there are at most ``capacity``
lengths, so the packing is planned on the histogram of lengths and is the same for ten
thousand or ten billion pieces:

* The largest length left opens a bin. A subset-sum dynamic programme over the lengths that
  are left, each as often as it is left (one bit per reachable sum), finds the fullest
  feasible combination for the rest of the bin; the combination is removed.
* It is removed as often as the histogram has all of it, so the plan has some thousand
  patterns at most (each one uses up a length or leaves fewer of it than one bin takes).

Spark does the rest in parallel: a task numbers its pieces within each length, running sums
over the tasks' counts (no more than tasks x ``capacity`` rows) turn that into a rank among
all pieces of the length, and the rank decides the pattern, the sequence and the offset.
No group of equal lengths is ever sorted or collected in one task.

Defined results: a null or empty text is one piece with the end token alone; repeated rows are packed
as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmetrics.llm.common import byte_slices, hold, ragged, text_parts, written
from deskmetrics.llm.units import Memo, forget, library, unit_offsets

CAPACITY = 1024
END_ID = 2
_MEMOS: dict[tuple, Memo] = {}

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"


def cut_lengths(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``tokens`` tokens: pieces per document, and each piece's start and length.

    Only the first piece may be shorter than ``capacity`` when a document is cut.
    """
    pieces = np.maximum(-(-tokens // capacity), 1)
    head = tokens - (pieces - 1) * capacity
    number = ragged(np.zeros(len(tokens), np.int64), pieces)
    own = np.repeat(head, pieces)
    start = np.where(number == 0, 0, own + (number - 1) * capacity)
    return pieces, start, np.where(number == 0, own, capacity)


def _memo(tokenizer: str, ranks: str | None) -> Memo:
    """The memory of this Python worker, kept from task to task."""
    hold("packing", lambda: (_MEMOS.clear(), forget()))
    if (tokenizer, ranks) not in _MEMOS:
        _MEMOS[tokenizer, ranks] = Memo(library(tokenizer, ranks))
    return _MEMOS[tokenizer, ranks]


def token_pieces(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    ranks: str | None = "byte_bpe_50k.tiktoken",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``rank`` counts a task's pieces of equal length. ``keep_ids`` adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(tokenizer, ranks)
        memo = _memo(tokenizer, ranks)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in byte_slices(batches, "text"):
            raw, off = text_parts(batch.column("text"))
            raw = own.fold(raw)
            units = unit_offsets(raw, off)
            places = memo.look(raw, units)
            lengths = memo.lengths[places]
            upto = np.append(0, np.cumsum(lengths))[np.searchsorted(units, off)]
            ends = upto[1:] + np.arange(1, len(upto))  # each document has its end token
            ids = np.empty(int(ends[-1]), "<u4")
            end = np.zeros(len(ids), bool)
            end[ends - 1] = True
            ids[~end] = memo.ids[ragged(memo.starts[places], lengths)]
            ids[end] = end_id
            tokens = np.diff(ends, prepend=0)
            pieces, start, length = cut_lengths(tokens, capacity)
            first = np.repeat(ends - tokens, pieces) + start
            view = memoryview(ids)
            crc = [zlib.crc32(view[a : a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [
                batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(tokens)), pieces))),
                pa.array(ragged(np.zeros(len(tokens), np.int64), pieces).astype(np.int32)),
                pa.array(start),
                pa.array(length),
                pa.array(np.array(crc, np.int64)),
                pa.array(np.full(len(length), task, np.int32)),
                pa.array(rank),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if keep_ids:
                upto = np.append(0, np.cumsum(length)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(upto), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def fullest(room: int, lengths: list[int], left: dict[int, int]) -> dict[int, int]:
    """The combination of lengths, each at most as often as ``left`` says, with the largest sum up to ``room``.

    Bit s of the set says that some combination has sum s. Lengths are tried from the largest;
    the search ends as soon as the room can be filled exactly.
    """
    reach, mask = 1, (2 << room) - 1
    steps: list[tuple[int, int, int]] = []
    for n in lengths:
        many = min(left[n], room // n)
        part = 1
        while many > 0 and not reach >> room & 1:
            part = min(part, many)
            steps.append((n, part, reach))
            reach |= reach << n * part & mask
            many -= part
            part *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for n, part, before in reversed(steps):
        if not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + part
            total -= n * part
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: pieces in a bin}) until no piece is left."""
    left = {n: c for n, c in histogram.items() if c > 0}
    patterns = []
    while left:
        largest = max(left)
        left[largest] -= 1
        pattern = fullest(capacity - largest, sorted((n for n in left if left[n] and n <= capacity - largest), reverse=True), left)
        left[largest] += 1
        pattern[largest] = pattern.get(largest, 0) + 1
        repeats = min(left[n] // m for n, m in pattern.items())
        patterns.append((repeats, pattern))
        for n, m in pattern.items():
            left[n] -= m * repeats
            if not left[n]:
                del left[n]
    return patterns


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, pieces in a bin, first sequence, first offset), ordered by length and rank."""
    rows, used, sequence = [], {}, 0
    for repeats, pattern in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, used.get(n, 0), pattern[n], sequence, offset))
            used[n] = used.get(n, 0) + pattern[n] * repeats
            offset += n * pattern[n]
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (materialised, with length, task and rank) with sequence_id and offset.

    ``rank`` must number the rows of each (task, length) from 0 without gaps.
    """
    counts = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-counts")
    histogram = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan(histogram, capacity))

    wide = 1 << 44
    keys = slots[:, 0] * wide + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            _, first, many, sequence, offset = slots[at].T
            k = rank - first
            own = [batch.column(c) for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(sequence + k // many), pa.array(offset + k % many * length)],
                [c for c in batch.schema.names if c != "rank"] + ["sequence_id", "offset"],
            )

    ranked = pieces.join(firsts.select("task", "length", "before"), ["task", "length"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **how) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(token_pieces(docs, capacity=capacity, **how), "packing-pieces")
    out = pack(pieces, capacity)
    own = [c for c in out.columns if c not in ("doc_id", "piece", "start", "length")]
    return out.select("doc_id", "piece", "start", "length", *own)
