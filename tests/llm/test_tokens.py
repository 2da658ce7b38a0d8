"""Token counts, BPE round trip and packing against the tokenizers library itself."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from edge_tables import corpus, edge_docs, no_docs  # noqa: F401
from deskmetrics.llm import bpe_codec, packing, token_counts
from deskmetrics.llm.common import byte_slices, ragged, text_parts
from deskmetrics.llm.units import Memo, library, unit_offsets

BYTE, WORD = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"), ("word_bpe_49k.json", None)
FRAGMENTS = [
    " ", "\n", "  ", "\t", " ", "　", "a", "Ab", "é", "É", "×", "ß", ".", "'s", "'S", "!!", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>",
    "|", "<", "12", "²", "́", "\x85", "\x1c", "日本", "Ω", "Σ", " ", "_", "İ", "#", "x" * 20, "the", " of",
]


def odd_texts(n, longest, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(FRAGMENTS, k=rng.randint(0, longest))) for _ in range(n)] + ["", "a" * 3000, " " * 2000, "日" * 500]


@pytest.mark.parametrize("name", [BYTE, WORD, ("byte_bpe_50k.json", None)])
def test_units_give_the_ids_of_whole_texts(name):
    own, texts = library(*name), odd_texts(4000, 25)
    memo = Memo(own)
    raw, off = text_parts(pa.array(texts))
    raw = own.fold(raw)
    units = unit_offsets(raw, off)
    places = memo.look(raw, units)
    upto = np.append(0, np.cumsum(memo.lengths[places]))[np.searchsorted(units, off)]
    ids = memo.ids[ragged(memo.starts[places], memo.lengths[places])]
    for text, a, b, want in zip(texts, upto[:-1], upto[1:], own.encode(texts), strict=True):
        assert ids[a:b].tolist() == want, repr(text)


def test_unit_memory_starts_anew_when_full():
    own = library(*WORD)
    memo = Memo(own, limit=10)
    for text in ("one two three " * 9, "four five six seven eight nine ten eleven twelve", "one thirteen"):
        raw, off = text_parts(pa.array([text]))
        units = unit_offsets(raw, off)
        places = memo.look(raw, units)
        assert memo.ids[ragged(memo.starts[places], memo.lengths[places])].tolist() == own.encode([text])[0]


@pytest.mark.parametrize("size", [8, 64, 1024])
@pytest.mark.parametrize("name", [BYTE, WORD])
def test_chunk_joins_are_exact(name, size, monkeypatch):
    plain = bpe_codec.chunk_offsets
    monkeypatch.setattr(bpe_codec, "chunk_offsets", lambda raw, off: plain(raw, off, size))
    own, texts = library(*name), odd_texts(400, 400, 3)
    chunks = bpe_codec.Chunks(own)
    raw, off = text_parts(pa.array(texts))
    ids, upto = chunks.encode(raw, off)
    assert [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:], strict=True)] == own.encode(texts)
    before = chunks.encoded
    chunks.encode(raw, off)
    assert chunks.encoded == before  # known chunks are not encoded again


def test_shared_passages_share_chunks():
    rng = random.Random(2)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(2000))
    texts = [f"{'x' * k} {passage} {k}" for k in range(6)]
    chunks = bpe_codec.Chunks(library(*WORD))
    chunks.encode(*text_parts(pa.array(texts)))
    assert chunks.encoded < 2 * len(texts[0])


def test_byte_slices_keep_rows_and_bound_bytes():
    texts = ["a" * n for n in (5, 0, 100, 3, 3, 3, 50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(byte_slices(iter([batch]), "text", 20))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= 20 for p in parts)


def whole(name, texts):
    return library(*name).encode([t or "" for t in texts])


def test_counts_of_the_corpus_and_edge_cases(spark, corpus, edge_docs, no_docs):
    for docs in (corpus[0], edge_docs):
        texts = docs.select("doc_id", "text").collect()
        got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(docs).collect())
        ids = whole(WORD, [r["text"] for r in texts])
        want = sorted((-1 if r["doc_id"] is None else r["doc_id"], len((r["text"] or "").encode()), len(i), len(i) > 2048) for r, i in zip(texts, ids, strict=True))
        assert got == want
    assert token_counts.count_tokens(no_docs).count() == 0


def test_counts_by_sentencepiece(spark, edge_docs):
    import public_tokenizers
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = edge_docs.where("doc_id IS NOT NULL").select("doc_id", "text").distinct().collect()
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(edge_docs, "piece_bpe_32k.model").collect()}
    assert all(got[r["doc_id"]] == len(own.encode(r["text"] or "")) for r in rows)


def test_roundtrip_outputs_and_digests(spark, corpus, edge_docs, no_docs):
    tokenizer = library(*WORD).tokenizer
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for docs in (corpus[0], edge_docs.where("doc_id IS NOT NULL")):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        ids = dict(zip(texts, whole(WORD, texts.values()), strict=True))
        for r in bpe_codec.roundtrip(docs).collect():
            assert r["ids"] == ids[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
            assert r["decoded"] == tokenizer.decode(r["ids"], skip_special_tokens=False)
        for r in bpe_codec.roundtrip(docs, then=bpe_codec.digests, schema=bpe_codec.DIGEST_SCHEMA).collect():
            own = ids[r["doc_id"]]
            assert r["ids_sha256"] == sha(" ".join(map(str, own))) and r["decoded_sha256"] == sha(tokenizer.decode(own, skip_special_tokens=False))
    assert bpe_codec.roundtrip(no_docs).count() == 0


def test_roundtrip_with_a_decoder(spark, corpus):
    """The byte-level tokenizer has a decoder: texts come back as they were."""
    for r in bpe_codec.roundtrip(corpus[0].limit(20), "byte_bpe_50k.json").collect():
        assert r["decoded"] == corpus[1][r["doc_id"]]


def packed(docs, capacity=1024):
    """Checks pieces against the library and places against each other; (sequences, tokens)."""
    rows = packing.pack_documents(docs, capacity).collect()
    texts = docs.select("doc_id", "text").distinct().collect()
    many = {r["doc_id"]: 0 for r in texts}
    for r in docs.select("doc_id").collect():
        many[r["doc_id"]] += 1
    ids = {r["doc_id"]: np.array([*i, packing.END_ID], "<u4") for r, i in zip(texts, whole(BYTE, [r["text"] for r in texts]), strict=True)}
    places, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for doc, own in pieces.items():
        n, times = len(ids[doc]), many[doc]
        assert sum(x[2] for x in own) == n * times
        count = -(-n // capacity)
        assert sorted(own) == sorted([(k, max(0, n - (count - k) * capacity), min(n, capacity) if k or count == 1 else n - (count - 1) * capacity) for k in range(count)] * times)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(len(ids[d]) * many[d] for d in many)


def test_packing_places_every_piece(spark, corpus, edge_docs, no_docs):
    sequences, tokens = packed(corpus[0])
    assert sequences <= 1.03 * tokens / 1024 + 1
    packed(edge_docs.where("doc_id IS NOT NULL"), 64)
    assert packing.pack_documents(no_docs).count() == 0


def test_bin_filling_is_as_full_as_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        lengths = sorted({rng.randint(1, 40) for _ in range(6)}, reverse=True)
        left = {n: rng.randint(1, 3) for n in lengths}
        room = rng.randint(1, 90)
        sums = {0}
        for n in lengths:
            sums = {s + k * n for s in sums for k in range(left[n] + 1) if s + k * n <= room}
        chosen = packing.fullest(room, lengths, left)
        assert sum(n * k for n, k in chosen.items()) == max(sums)
        assert all(k <= left[n] for n, k in chosen.items())


def test_plan_uses_every_piece_once_and_stays_small():
    rng = random.Random(5)
    histogram = {n: rng.randint(0, 10**9) for n in range(1, 1025)}
    plan = packing.plan(histogram)
    used = defaultdict(int)
    for repeats, pattern in plan:
        assert sum(n * k for n, k in pattern.items()) <= 1024
        for n, k in pattern.items():
            used[n] += repeats * k
    assert dict(used) == {n: c for n, c in histogram.items() if c}
    assert len(plan) < 10_000
    tokens = sum(n * c for n, c in histogram.items())
    assert sum(r for r, _ in plan) <= 1.02 * tokens / 1024 + 1
