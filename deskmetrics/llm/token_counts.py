"""Token counts: batch encoding in Arrow functions that return lengths only.

Every Arrow batch is cut into slices of about equal bytes. The texts of a slice, short or
long, are split at safe boundaries (``units``), the distinct pieces are encoded in batches,
and only the number of ids of each piece is kept; a text's count is the sum over its pieces.
Tokenizer files for which no safe boundaries are known get whole texts, in the same slices.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated
results; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm.common import byte_slices, hold, text_parts
from deskmetrics.llm.units import Memo, forget, library, unit_offsets

#: Tokenizer files whose pre-tokens end at the boundaries of ``units``.
SPLITTABLE = ("byte_bpe_50k.json", "word_bpe_49k.json")
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

_MEMOS: dict[str, Memo] = {}


class Lengths(Memo):
    """A memory of lengths alone."""

    def added(self, units, ids, lengths) -> None:
        self.ids = np.zeros(0, np.uint32)


def _memo(tokenizer: str) -> Lengths:
    """The memory of this Python worker, kept from task to task."""
    hold("token_counts", lambda: (_MEMOS.clear(), forget()))
    if tokenizer not in _MEMOS:
        _MEMOS[tokenizer] = Lengths(library(tokenizer))
    return _MEMOS[tokenizer]


def count_tokens(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``)."""

    def lengths(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        if tokenizer.endswith(".model"):
            return _pieces(tokenizer, raw, off)
        own = library(tokenizer)
        if tokenizer not in SPLITTABLE:
            texts = [bytes(raw[a:b]).decode() for a, b in zip(off[:-1], off[1:], strict=True)]
            return np.array([len(ids) for ids in own.encode(texts)], np.int64)
        memo = _memo(tokenizer)
        raw = own.fold(raw)
        units = unit_offsets(raw, off)
        places = memo.look(raw, units)
        total = np.append(0, np.cumsum(memo.lengths[places]))
        return np.diff(total[np.searchsorted(units, off)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            raw, off = text_parts(batch.column("text"))
            n = lengths(raw, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


_PIECES: dict[str, object] = {}


def _pieces(name: str, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    import public_tokenizers
    import sentencepiece

    if name not in _PIECES:
        _PIECES[name] = sentencepiece.SentencePieceProcessor(model_file=name if "/" in name else public_tokenizers.path(name))
    texts = [bytes(raw[a:b]).decode() for a, b in zip(off[:-1], off[1:], strict=True)]
    return np.array([len(ids) for ids in _PIECES[name].encode(texts, num_threads=1)], np.int64)
