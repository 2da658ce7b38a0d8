"""Exact tokenisation by reuse of safe units.

A *safe boundary* is a place where the two public BPE tokenizers used here always end one
pre-token and start another, whatever stands further left or right:

* in front of a space or line feed whose left neighbour is not white space;
* behind a single line feed between such a place and an ASCII letter;
* between a letter and an ASCII punctuation mark other than ``|`` (which ends special strings).

Between two safe boundaries lies a *unit* (usually one word with the space before it), and
the ids of a text are the ids of its units, one after another. Units repeat far more often
than texts do, so each distinct unit is encoded once and remembered while the Python worker
lives (up to ``MEMO_UNITS`` units; then the memory starts anew, which changes no result).

Texts without such boundaries (no spaces, other scripts' spaces) simply make long units.
"""

from __future__ import annotations

import os
import re

import numpy as np

from deskmetrics.llm.common import binary_array, ragged

#: Remembered units of one worker; about 200 bytes each.
MEMO_UNITS = 250_000
#: Units handed to the library at once.
BLOCK = 4_096

_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("|")]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[c for c in range(128) if chr(c).isalpha()]] = True
#: One pre-token of letters for either tokenizer: ASCII and Latin-1 letters, which NFC leaves as they are.
_LETTERS = re.compile(rb" ?((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)").fullmatch


def safe_boundaries(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A mask over ``raw``: true where a cut in front of the byte is safe. ``starts``: where texts start.

    Beyond ASCII the left neighbour may be the last byte of another script's white space
    (two bytes C2 xx, or three that start E1 9A, E2 80, E2 81, E3 80); such places are left alone.
    """
    cut = np.zeros(len(raw), bool)
    if len(raw) < 2:
        return cut
    left, right = raw[:-1], raw[1:]
    blank = (raw == 32) | (raw == 10)
    own = cut[1:]
    own |= blank[1:] & (left > 32) & (left < 127)
    own |= _MARK[right] & _ALPHA[left]
    at = np.flatnonzero(left >= 128)
    at = at[blank[at + 1] | _MARK[right[at]]]
    if len(at):
        two, three = raw[np.maximum(at - 1, 0)], raw[np.maximum(at - 2, 0)]
        space = (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A)))
        latin = (two == 0xC3) & (raw[at] != 0x97) & (raw[at] != 0xB7)
        own[at] = np.where(blank[at + 1], ~space, latin)
    cut[starts[starts < len(raw)]] = False  # what stands left of a text does not count
    own |= (left == 10) & cut[:-1] & _ALPHA[right]
    return cut


def unit_offsets(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending offsets of the units of all texts; every text starts a unit. Empty texts add none."""
    cut = np.append(safe_boundaries(raw, offsets), True)
    cut[offsets] = True
    return np.flatnonzero(cut)


def _byte_alphabet() -> dict[int, int]:
    """The byte-level tokenizers' character for each byte: itself where printable, else 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class Library:
    """A public tokenizer file. Special strings inside texts count as the special token, its default.

    Most units are one pre-token of letters; those go straight to the BPE model: the library's own,
    or, given ``ranks`` (a rank file of the same vocabulary), tiktoken's, which is faster. All others
    go through the whole library. The first block of a worker is held against the whole library.
    """

    def __init__(self, name: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        #: The normalizer drops white space and case.
        self.folds = self.tokenizer.normalizer is not None
        self.ranked = _ranked(public_tokenizers, ranks) if ranks else None
        self.checked = False

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fold(self, raw: np.ndarray) -> np.ndarray:
        """Bytes with the same ids but fewer distinct units: what the normalizer drops anyway goes first."""
        if not self.folds or b"<|" in raw.tobytes():  # a capitalised special string isn't one
            return raw
        out = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        out[out == 10] = 32
        return out

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each unit."""
        letters = [i for i, unit in enumerate(units) if _LETTERS(unit)]
        others = sorted(set(range(len(units))).difference(letters))
        lengths = np.zeros(len(units), np.int64)
        model = self._by_ranks if self.ranked else self._by_model
        flat, own = model([units[i] for i in letters])
        if letters and not self.checked:
            sample = [units[i].decode() for i in letters[:256]]
            if [i for ids in self.encode(sample) for i in ids] != flat[: int(own[:256].sum())].tolist():
                raise ValueError("the BPE model and the whole library disagree")
            self.checked = True
        lengths[letters] = own
        rest: list[list[int]] = []
        for start in range(0, len(others), BLOCK):
            rest += self.encode([units[i].decode() for i in others[start : start + BLOCK]])
        lengths[others] = [len(ids) for ids in rest]
        out = np.empty(int(lengths.sum()), np.uint32)
        starts = np.cumsum(lengths) - lengths
        out[ragged(starts[letters], own)] = flat
        out[ragged(starts[others], lengths[others])] = [i for ids in rest for i in ids]
        return out, lengths

    def _by_model(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, alphabet = self.model.tokenize, self.alphabet
        if self.folds:
            units = [u.decode().strip(" ").lower().encode() for u in units]
        found = [[t.id for t in tokenize(u.decode("latin-1").translate(alphabet))] for u in units]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64)

    def _by_ranks(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units joined by line feeds, each a token of its own between letters and blanks."""
        found, lengths = [], []
        line = self.ranked.encode_ordinary("\n")[0]
        for start in range(0, len(units), BLOCK):
            block = units[start : start + BLOCK]
            ids = np.array(self.ranked.encode_ordinary(b"\n".join(block).decode()), np.uint32)
            ends = np.append(np.flatnonzero(ids == line), len(ids))
            if len(ends) != len(block):
                raise ValueError("line feeds do not keep units apart")
            lengths.append(np.diff(ends, prepend=-1) - 1)
            found.append(ids[ids != line])
        return np.concatenate(found or [np.zeros(0, np.uint32)]), np.concatenate(lengths or [np.zeros(0, np.int64)])


def _ranked(files, ranks: str):
    import base64

    import tiktoken

    with open(ranks if os.path.sep in ranks else files.path(ranks), "rb") as lines:
        merged = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranked", pat_str=files.PATTERN, mergeable_ranks=merged, special_tokens={})


class Memo:
    """Ids of units that this worker has met, as flat arrays; ``look`` gives each unit's place in them."""

    def __init__(self, library: Library, limit: int = MEMO_UNITS):
        self.library, self.limit = library, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def look(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Place of every unit; unseen ones are encoded, each once."""
        coded = binary_array(raw, offsets).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > self.limit:
            self.clear()
        place = self.place
        new = [u for u in distinct if u not in place]
        if new:
            ids, lengths = self.library.encode_units(new)
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.starts = np.concatenate([self.starts, starts])
            self.added(new, ids, lengths)
        own = np.fromiter(map(place.__getitem__, distinct), np.int64, len(distinct))
        return own[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)

    def added(self, units: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Hook for what a caller keeps beside the ids."""


_LIBRARIES: dict[tuple, Library] = {}


def library(name: str, ranks: str | None = None) -> Library:
    """The tokenizer of this Python worker; loaded once."""
    if (name, ranks) not in _LIBRARIES:
        _LIBRARIES[name, ranks] = Library(name, ranks)
    return _LIBRARIES[name, ranks]


def forget() -> None:
    """Drop the loaded tokenizers of this worker."""
    _LIBRARIES.clear()
