"""Quality classifier: histogram gradient-boosted trees over document statistics.

``document_statistics`` turns whole texts into ``STATISTICS`` (shares of character kinds, lengths,
repetition of words and lines), vectorised over the bytes of a batch. The trees are fitted on at
most ``TRAIN_ROWS`` labelled rows (those whose id has the smallest hash; the only bounded part)
and every row of the table is scored in its own task with the flat arrays of the model.

Ids, languages, sources and labels are never inputs of a score.

Defined results: a null or empty text has all-zero statistics and gets a score like any other;
labels other than 0 and 1 and labels without id are ignored, several labels of an id count as their
rounded mean; without usable labels every score is 0.5; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm import trees
from deskmetrics.llm.common import binary_array, byte_slices, count_in, hash_sample, release, text_parts

TRAIN_ROWS = 20_000
FOLDS = 5
HELD_OUT = 0
KEEP_FROM = 0.3

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "mean_word", "mean_line_words", "symbols", "exclamations", "bars", "upper", "digits",
    "stops", "commas", "blanks", "wide", "distinct_words", "twin_words", "repeated_lines", "top_line_words", "unended_lines",
)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_KINDS = {
    "symbols": _class("#*$%&|<>"),
    "exclamations": _class("!?"),
    "bars": _class("|"),
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _class("0123456789"),
    "stops": _class("."),
    "commas": _class(",;:"),
    "blanks": _class(" \t\r\n\x0b\x0c"),
    "lines": _class("\n"),
    "wide": np.arange(256) >= 0xC0,
}


def document_statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, ``STATISTICS``) of UTF-8 texts given as bytes and n + 1 offsets."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    per = np.maximum(size, 1)

    kinds = {k: count_in(table[raw], off) for k, table in _KINDS.items()}
    blank = _KINDS["blanks"][raw]
    starts = np.zeros(len(raw) + 1, bool)
    starts[off] = True
    ahead = np.append(True, blank)[: len(raw)] | starts[:-1]
    first = np.flatnonzero(~blank & ahead)
    behind = np.append(blank, True)[1:] | starts[1:]
    last = np.flatnonzero(~blank & behind) + 1
    doc = np.searchsorted(off, first, side="right") - 1
    words = np.bincount(doc, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    code = _codes(raw, first, last)
    twins = np.bincount(doc[1:][(code[1:] == code[:-1]) & (doc[1:] == doc[:-1])], minlength=n) if len(doc) else np.zeros(n)
    wide = int(code.max(initial=0)) + 1
    distinct = np.bincount(np.unique(doc * wide + code) // wide, minlength=n) if len(doc) else np.zeros(n)

    ends = np.flatnonzero((raw == 10) | starts[1:])  # the last byte of each line
    begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
    of_line = np.searchsorted(off, begins, side="right") - 1
    line_words = np.searchsorted(first, ends + 1) - np.searchsorted(first, begins)
    full = line_words > 0
    begins, ends, of_line, line_words = begins[full], ends[full], of_line[full], line_words[full]
    lines = np.bincount(of_line, minlength=n).astype(float)
    per_line = np.maximum(lines, 1)
    line = _codes(raw, begins, ends + (raw[ends] != 10)) if len(ends) else ends
    wide = int(line.max(initial=0)) + 1
    single = np.bincount(np.unique(of_line * wide + line) // wide, minlength=n) if len(line) else np.zeros(n)
    longest = np.zeros(n)
    np.maximum.at(longest, of_line, line_words)
    mark = raw[np.maximum(ends - (raw[ends] == 10), 0)] if len(ends) else ends
    unended = np.bincount(of_line[~np.isin(mark, [ord(c) for c in ".!?:;\"')"])], minlength=n) if len(ends) else np.zeros(n)

    return np.stack(
        [
            np.log1p(size), np.log1p(words), np.log1p(lines), (size - kinds["blanks"]) / per_word, words / per_line,
            kinds["symbols"] / per_word, kinds["exclamations"] / per_word, kinds["bars"] / per_word, kinds["upper"] / per,
            kinds["digits"] / per, kinds["stops"] / per_word, kinds["commas"] / per_word, kinds["blanks"] / per,
            kinds["wide"] / per, distinct / np.sqrt(per_word), twins / per_word, (lines - single) / per_line, longest / per_word, unended / per_line,
        ],
        1,
    )


def _codes(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number for each stretch of bytes, equal for equal stretches."""
    if not len(first):
        return np.zeros(0, np.int64)
    both = np.append(np.stack([first, last], 1).ravel(), len(raw))  # stretches and gaps by turns
    coded = binary_array(raw, both).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False)[0::2].astype(np.int64)


def fold(id_col: str, folds: int = FOLDS):
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled rows outside the held-out fold.

    The ids that are kept have the smallest hashes, so the choice depends on neither order nor
    partitioning. Their number is bounded, which makes the broadcast one of bounded size.
    """
    usable = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label).alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)
    )
    usable = usable.groupBy("doc_id").agg(F.round(F.avg("y")).cast("int").alias("y"))
    kept = hash_sample(usable.where(fold("doc_id") != HELD_OUT), "doc_id", rows)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(kept), "doc_id")


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text"):
        x = document_statistics(*text_parts(batch.column("text")))
        flat = pa.array(x.ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), lists], ["doc_id", "y", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label: str = "quality") -> trees.Trees:
    """Trees from at most ``rows`` labelled ids; repeated documents of an id weigh as one."""
    sample = training_sample(docs, labels, label, rows).mapInArrow(_statistics_rows, "doc_id bigint, y int, x array<double>")
    got = sample.dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(STATISTICS))
    model = trees.fit(x, got["y"].to_numpy(float))
    del got, x
    release()  # the driver outlives the fit
    return model


def score(docs: DataFrame, model: trees.Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            s = model.score(document_statistics(*text_parts(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= KEEP_FROM).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id bigint, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", (fold("doc_id") == HELD_OUT).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, whole, whose text the classifier accepts."""
    model = fit(docs, labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            s = model.score(document_statistics(*text_parts(batch.column("text"))))
            yield batch.filter(pa.array(s >= KEEP_FROM)).select(names)

    return docs.mapInArrow(run, docs.schema)
