"""BPE encoding and decoding by reuse of content-defined chunks.

1. A rolling hash over ``WINDOW`` bytes cuts every text into chunks of about
   ``CHUNK_BYTES``. The cuts depend on nearby content only, so copies, near copies and
   passages that documents share fall into the same chunks.
2. Each distinct chunk is encoded once and remembered while the Python worker lives; every
   further occurrence, in whatever document, takes the ids from the memory. Inside, a chunk
   is a run of units between safe boundaries (``units``).
3. A cut may fall anywhere, also inside a word, so the first and last unit of a chunk are not to be
   relied on where another chunk adjoins. At each join, the text from the last safe boundary left of the
   cut to the first one right of it is encoded anew; where a chunk has no safe boundary inside, the
   window grows over it and further chunks until both its ends are safe. There the ids to the
   left and right agree exactly with those of the whole text, whatever the cut was.

Memory is bounded by ``CHUNK_MEMO`` unit places and the unit memory; when full, they start anew.

Defined results: a null text is empty and gives no ids and an empty decoded text; special
strings inside texts become special tokens, the library's default; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm.common import binary_array, byte_slices, hold, ragged, text_parts
from deskmetrics.llm.units import Library, Memo, forget, library, unit_offsets

WINDOW = 16
CHUNK_BYTES = 1024
#: Unit places that a worker remembers for chunks.
CHUNK_MEMO = 3_000_000

SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, decoded string"


def _gear() -> np.ndarray:
    """A fixed pseudo-random 32-bit number for every byte value."""
    return np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def chunk_offsets(raw: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> np.ndarray:
    """Ascending offsets of the chunks of all texts. A cut never splits a character or looks over a text's start."""
    cut = np.zeros(len(raw) + 1, bool)
    if len(raw) > WINDOW:
        h = _gear()[raw]
        for span in (1, 2, 4, 8):  # the sum over the last 16 bytes, each shifted by its distance
            h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        at = np.flatnonzero(h & np.uint32(0xFFFF) < 65536 // size) + 1
        at = at[at < len(raw)]
        at = at[(raw[at] & 0xC0) != 0x80]
        start = offsets[np.searchsorted(offsets, at, side="right") - 1]
        cut[at[at - start >= WINDOW]] = True
    cut[offsets] = True
    return np.flatnonzero(cut)


class Chunks:
    """What a worker remembers: the units, and for each chunk met the places of its units and their byte ends."""

    def __init__(self, own: Library, limit: int = CHUNK_MEMO):
        self.own, self.limit = own, limit
        self.units = Memo(own)
        self.clear()

    def clear(self) -> None:
        self.units.clear()
        self.known: dict[bytes, int] = {}
        self.places = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.head = np.zeros(0, np.int64)
        self.tail = np.zeros(0, np.int64)
        self.encoded = 0

    def look(self, raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Number of each chunk; chunks not met before are encoded, each once."""
        coded = binary_array(raw, cuts).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        keys = [hashlib.blake2b(c, digest_size=16).digest() for c in distinct]
        if len(self.places) > self.limit or len(self.units.place) > self.units.limit:
            self.clear()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            joined = np.frombuffer(b"".join([distinct[i] for i in new]), np.uint8)
            off = np.append(0, np.cumsum([len(distinct[i]) for i in new]))
            ends = unit_offsets(joined, off)
            limit, self.units.limit = self.units.limit, len(ends) + len(self.units.place) + 1  # no clearing midway
            places = self.units.look(joined, ends)
            self.units.limit = limit
            first = np.searchsorted(ends, off)
            self.known.update(zip([keys[i] for i in new], range(len(self.known), len(self.known) + len(new)), strict=True))
            self.start = np.append(self.start, len(self.places) + first[:-1])
            self.count = np.append(self.count, np.diff(first))
            self.head = np.append(self.head, ends[first[:-1] + 1] - off[:-1])
            self.tail = np.append(self.tail, off[1:] - ends[first[1:] - 1])
            self.places = np.append(self.places, places.astype(np.int32))
            self.encoded += len(joined)
        own = np.fromiter((self.known[k] for k in keys), np.int64, len(keys))
        return own[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and n + 1 offsets into them."""
        raw = self.own.fold(raw)
        cuts = chunk_offsets(raw, off)
        which = self.look(raw, cuts)
        texts = np.zeros(len(raw) + 1, bool)
        texts[off] = True
        joined_left, joined_right = ~texts[cuts[:-1]], ~texts[cuts[1:]]
        start, count = self.start[which], self.count[which]
        # Windows over the joins; those that meet in a chunk of one unit are one window.
        at = np.flatnonzero(joined_right)
        left = cuts[at + 1] - self.tail[which[at]]
        right = cuts[at + 1] + self.head[which[at + 1]]
        opens = ~((count[at] == 1) & joined_left[at])
        group = np.cumsum(opens) - 1
        n = int(opens.sum())
        window_left = left[opens]
        window_right = np.zeros(n, np.int64)
        window_right[group] = right  # the last one stays
        size = window_right - window_left
        again = raw[ragged(window_left, size)] if n else np.zeros(0, np.uint8)
        again_off = np.append(0, np.cumsum(size))
        again_ends = unit_offsets(again, again_off)
        limit, self.units.limit = self.units.limit, len(again_ends) + len(self.units.place) + 1
        again_places = self.units.look(again, again_ends)
        self.units.limit = limit
        first = np.searchsorted(again_ends, again_off)
        # Each chunk gives its inner units, then the window that opens at its right end.
        pool = np.concatenate([self.places, again_places.astype(np.int32)])
        drop_head, drop_tail = joined_left.astype(np.int64), joined_right.astype(np.int64)
        from_ = np.zeros((len(which), 2), np.int64)
        many = np.zeros((len(which), 2), np.int64)
        from_[:, 0] = start + drop_head
        many[:, 0] = np.maximum(count - drop_head - drop_tail, 0)
        from_[at[opens], 1] = len(self.places) + first[:-1]
        many[at[opens], 1] = np.diff(first)
        places = pool[ragged(from_.ravel(), many.ravel())]
        lengths = self.units.lengths[places]
        units_upto = np.append(0, np.cumsum(many.sum(axis=1)))[np.searchsorted(cuts, off)]
        ids_upto = np.append(0, np.cumsum(lengths))
        return self.units.ids[ragged(self.units.starts[places], lengths)], ids_upto[units_upto]


_CHUNKS: dict[str, Chunks] = {}
_TOKENS: dict[str, pa.Array] = {}


def _tokens(name: str) -> pa.Array:
    """Each id's token as the decoder writes it, with the blank that follows."""
    if name not in _TOKENS:
        own = library(name).tokenizer
        size = max(own.get_vocab(with_added_tokens=True).values()) + 1
        _TOKENS[name] = pa.array([((own.id_to_token(i) or "") + " ").encode() for i in range(size)], pa.large_binary())
    return _TOKENS[name]


def _decode(name: str, ids: np.ndarray, upto: np.ndarray) -> list[str]:
    own = library(name).tokenizer
    if own.decoder is not None:
        return own.decode_batch([ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:], strict=True)], skip_special_tokens=False)
    # Without a decoder the library joins the tokens by blanks.
    _, off, data = _tokens(name).take(pa.array(ids)).buffers()
    if not len(ids):
        return [""] * (len(upto) - 1)
    ends = np.frombuffer(off, np.int64)[upto]
    view = memoryview(data)
    return [str(view[a : max(a, b - 1)], "utf-8") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _chunks(name: str) -> Chunks:
    """The memory of this Python worker, kept from task to task."""
    hold("bpe_codec", lambda: (_CHUNKS.clear(), _TOKENS.clear(), _DECIMAL.clear(), forget()))
    if name not in _CHUNKS:
        _CHUNKS[name] = Chunks(library(name))
    return _CHUNKS[name]


def roundtrip(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = SCHEMA,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids, decoded. ``then`` maps these batches, in the same task, to ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _chunks(tokenizer)
        for batch in byte_slices(batches, "text"):
            raw, off = text_parts(batch.column("text"))
            ids, upto = chunks.encode(raw, off)
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(upto)),
                    pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32))),
                    pa.array(_decode(tokenizer, ids, upto), pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )
            yield then(out) if then else out

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


DIGEST_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_DECIMAL: list[pa.Array] = []


def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    """doc_id, n_tokens and SHA-256 of the ids (decimal, joined by one blank) and of the decoded text."""
    if not _DECIMAL:
        _DECIMAL.append(pa.array([f"{i} ".encode() for i in range(1 << 16)], pa.large_binary()))
    lists = batch.column("ids")
    ids, upto = lists.values, lists.offsets.to_numpy()
    _, off, data = _DECIMAL[0].take(ids).buffers()
    ends = np.frombuffer(off, np.int64)[upto] if len(ids) else np.zeros(len(upto), np.int64)
    view = memoryview(data) if len(ids) else memoryview(b"")
    of_ids = [hashlib.sha256(view[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    of_text = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in batch.column("decoded")]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("n_tokens"), pa.array(of_ids), pa.array(of_text)],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )
