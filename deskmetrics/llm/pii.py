"""Personal data: candidate spans from generous patterns, judged by boosted trees, redacted above calibrated thresholds.

*Base spans* are what the fixed patterns find and their checks confirm (leftmost, not overlapping, per kind; a match
that fails its check is dropped). They always count.

*Candidates* come from generators that accept far more: numbers glued to other numbers, other separators,
phones without a plus sign, mail addresses with ``(at)`` and ``[dot]``, parts of dotted runs. They may overlap each other and
be wrong. Every candidate is described by its format (lengths, groups, separators, check digit, ...) and its context (characters
and words beside it), and boosted trees give the probability that it is personal data of its kind. Of the candidates that
reach their kind's threshold, the likeliest that overlap no base span or chosen one are added.

*Training* needs no labels: at most ``TRAIN_SPANS`` base spans of ``TRAIN_DOCS`` documents (smallest id hash) are rewritten in other
formats and set beside other numbers, in their own contexts, and distractors (dates, prices, versions, order numbers, hex
strings, numbers whose check fails) take their places as negatives. Candidates are labelled by whether they are exactly
the planted span. Each kind's threshold is the lowest with a precision of ``PRECISION`` on a quarter of
the spans that the trees did not see.

Defined results: null and empty texts have no spans; without base spans in the sample nothing is added to the base; repeated rows
give repeated results; an empty table gives an empty result; other columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm import trees
from deskmetrics.llm.common import byte_slices, count_in, hash_sample, text_parts

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 40_000
TRAIN_SPANS = 3_000
PRECISION = 0.99
LEAST_THRESHOLD = 0.5
CONTEXT = 40

Span = tuple[int, int]

# ---- base ----------------------------------------------------------------------------------------
# The patterns of the contract in forms that take linear time on any text: possessive repeats, and starts
# only where an earlier start could not have matched.
_LOCAL = "".join(chr(c) for c in range(128) if chr(c).isalnum()) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[0::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def _ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        # The local part is all of its characters directly left of the sign, back to the last address.
        left = max(done, at - 1)
        head = text[done:at]
        start = done + len(head.rstrip(_LOCAL)) if head else left
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """What the fixed patterns and checks find."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    found["ip"] = [m.span() for m in _IP.finditer(text) if _ip_ok(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            found["card"].append(m.span())
    if "+" in text:
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


# ---- candidates ----------------------------------------------------------------------------------
_EDGE, _STOP = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
_AT = r" ?(?:@|\(at\)|\[at\]|\{at\}) ?"
_DOT = r"(?:\.| ?(?:\(dot\)|\[dot\]|\{dot\}) ?)"
GENERATORS = (
    ("email", re.compile(rf"{_EDGE}[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)),
    ("ip", re.compile(rf"{_EDGE}[0-9]{{1,3}}(?:(?:\.|\[\.\]|\(\.\))[0-9]{{1,3}}){{3}}(?![0-9])")),
    ("card", re.compile(rf"{_EDGE}[0-9]{{13,19}}{_STOP}")),
    ("card", re.compile(rf"{_EDGE}[0-9]{{4}}(?:[ ./-][0-9]{{4}}){{3}}{_STOP}")),
    ("card", re.compile(rf"{_EDGE}3[0-9]{{3}}[ ./-][0-9]{{6}}[ ./-][0-9]{{5}}{_STOP}")),
    ("phone", re.compile(rf"(?<![A-Za-z0-9])(?:\+|00)[0-9]{{1,3}}[ .-]?\(?[0-9]{{2,4}}\)?(?:[ .-]?[0-9]{{2,4}}){{2}}{_STOP}")),
    ("phone", re.compile(rf"{_EDGE}\(?[0-9]{{3}}\)?[ .-]?[0-9]{{3}}[ .-][0-9]{{4}}{_STOP}")),
    ("phone", re.compile(rf"{_EDGE}0[0-9]{{1,4}}(?:[ ./-][0-9]{{2,4}}){{2,4}}{_STOP}")),
    ("phone", re.compile(rf"{_EDGE}[0-9]{{9,15}}{_STOP}")),
)
#: A text without any of these characters has neither base spans nor candidates.
TRIGGER = np.zeros(256, bool)
TRIGGER[[ord(c) for c in "0123456789@([{"]] = True


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), each once; spans may overlap."""
    found = set()
    for kind, pattern in GENERATORS:
        number, at = KINDS.index(kind), 0
        while m := pattern.search(text, at):
            found.add((number, *m.span()))
            # Numbers beside each other may pair up in several ways: go on behind the first group.
            step = re.compile(r"[0-9A-Za-z]+").search(text, m.start())
            at = max(step.end() if step and kind != "email" else m.end(), m.start() + 1)
    return sorted(found)


_WORDS = {
    0: ("mail", "contact", "write", "address", "kontakt", "correo", "courriel"),
    1: ("ip", "host", "server", "address", "client", "from", "addr"),
    2: ("card", "visa", "credit", "karte", "tarjeta", "carte", "payment"),
    3: ("tel", "phone", "call", "mobile", "fax", "cell", "telefon", "appel", "llama"),
}


def describe(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    own = text[start:end]
    digits = digits_of(own)
    groups = re.findall(r"[0-9]+", own) or [""]
    sizes = [len(g) for g in groups]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    left, right = before[-1:], after[:1]
    kind_of = lambda c: 0 if not c else 1 if c in " \n\t" else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in ".,;:)!?" else 5 if c in "=\"'" else 6
    words = set(re.findall(r"[a-z]+", before.lower()))
    dot = own.rfind(".")
    return [
        kind, end - start, len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], own.count(" "), own.count("."), own.count("-"),
        own.count("/"), own.count("("), own.startswith("+"), own.startswith("00"), own.startswith("0"), len(digits) >= 12 and luhn(digits),
        max((int(g[:6] or 0) for g in groups), default=0), "@" in own, "(at)" in own.lower() or "[at]" in own.lower(), end - start - dot if dot >= 0 else 0,
        sum(c.isalpha() for c in own) / max(len(own), 1), int(digits[:2] or 0) if kind == 2 else -1, kind_of(left), kind_of(right),
        sum(c.isdigit() for c in before[-12:]), sum(c.isdigit() for c in after[:12]), left == "+" or before[-2:-1] == "+",
        before.endswith((". ", "\n")) or not before, any(w in words for w in _WORDS[kind]), "=" in before[-4:], before.rstrip().endswith(("$", "€", "#", "No.")),
    ]


# ---- training ------------------------------------------------------------------------------------
def _formats(kind: str, text: str, rng: random.Random) -> str:
    """The same datum in one of several formats."""
    digits = digits_of(text)
    if kind == "email":
        local, domain = text.split("@", 1)
        return rng.choice([text, text, f"{local}(at){domain}", f"{local} [at] {domain.replace('.', ' [dot] ')}", f"{local} @ {domain}", f"{local}[at]{domain}"])
    if kind == "ip":
        return rng.choice([text, text, text.replace(".", "[.]"), text.replace(".", "(.)")])
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice([digits, digits, *(s.join(four) for s in (" -./" if len(digits) == 16 else "")), text])
    area = digits[-10:-7], digits[-7:-4], digits[-4:]
    if len(digits) < 10:
        return text
    return rng.choice([text, text, text, "({}) {}-{}".format(*area), "{}-{}-{}".format(*area), "{}.{}.{}".format(*area), "+{} {} {} {}".format(digits[:-10] or "1", *area)])


def _distractor(kind: str, text: str, rng: random.Random) -> str:
    """Something that looks like the datum and is none."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "card" and rng.random() < 0.5:
        digits = digits_of(text)
        return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
    if kind == "ip" and rng.random() < 0.5:
        return rng.choice([".".join(str(rng.randint(256, 999)) for _ in range(4)), f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", "1." + text[:3]])
    return rng.choice(
        [
            f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{number(2)},{number(3)}.{number(2)}", f"{rng.randint(0, 20)}.{rng.randint(0, 9)}.{rng.randint(0, 30)}",
            number(rng.randint(4, 12)), number(rng.choice([13, 14, 17, 18, 19])), f"{rng.randint(1, 12)}:{number(2)}", f"{number(4)}-{number(4)}", f'"{rng.randbytes(20).hex()}"',
            f"No. {number(9)}", f"${number(5)}", f"{number(3)} {number(3)}", f"@{'x' * rng.randint(3, 8)}", f"{number(2)}/{number(2)}/{number(4)}",
        ]
    )


@dataclass
class Judge:
    model: trees.Trees | None
    threshold: dict[int, float]

    def choose(self, text: str, base: dict[str, list[Span]]) -> list[tuple[int, int, int, float]]:
        """Accepted candidates (kind, start, end, score), likeliest first, that overlap no base span and none before them."""
        if self.model is None:
            return []
        taken = Intervals(s for spans in base.values() for s in spans)
        open_ = [c for c in candidates(text) if not taken.meet(c[1], c[2])]
        if not open_:
            return []
        score = self.model.score(np.array([describe(text, *c) for c in open_], float))
        chosen: list[tuple[int, int, int, float]] = []
        for s, c in sorted(zip(score.tolist(), open_, strict=True), key=lambda x: (-x[0], x[1])):
            if s >= self.threshold.get(c[0], np.inf) and not taken.meet(c[1], c[2]):
                chosen.append((*c, s))
                taken.add(c[1], c[2])
        return chosen


class Intervals:
    """Disjoint intervals in order: spans that overlap are merged, so one look to the left tells whether another meets any."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meet(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start

    def add(self, start: int, end: int) -> None:
        """An interval that meets none of them."""
        at = bisect.bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def fit(docs: DataFrame, train_spans: int = TRAIN_SPANS) -> Judge:
    """Trees and thresholds from at most ``train_spans`` base spans."""

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            rows = []
            for i, text in _triggered(batch):
                for kind, spans in base_spans(text).items():
                    rows += [(batch.column("doc_id")[i].as_py(), kind, text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT]) for a, b in spans[:2]]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "kind", "before", "own", "after"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    ids = hash_sample(own.select("doc_id"), "doc_id", TRAIN_DOCS)  # bounded, so a broadcast of bounded size
    own = own.join(F.broadcast(ids.distinct()), "doc_id")
    found = own.mapInArrow(snippets, "doc_id bigint, kind string, before string, own string, after string")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "kind", "before", "own").limit(train_spans).collect()
    return train([tuple(r) for r in rows])


def train(rows: list[tuple]) -> Judge:
    """From (doc_id, kind, before, own, after) of base spans."""
    x, y, held = [], [], []
    for doc_id, kind, before, own, after in rows:
        rng = random.Random(f"{doc_id} {own}")
        part = rng.random() < 0.25
        for turn in range(6):
            planted = turn < 3
            text = _formats(kind, own, rng) if planted else _distractor(kind, own, rng)
            left, right = before, after
            if rng.random() < 0.4:  # beside another number
                _, k, _, more, _ = rng.choice(rows)
                more = _formats(k, more, rng)
                left, right = (f"{left}{more} ", right) if rng.random() < 0.5 else (left, f" {more}{right}")
            whole = left + text + right
            truth = (KINDS.index(kind), len(left), len(left) + len(text))
            for c in candidates(whole):
                if c[1] < truth[2] and truth[1] < c[2]:
                    x.append(describe(whole, *c))
                    y.append(float(planted and c == truth))
                    held.append(part)
    if not x:
        return Judge(None, {})
    x, y, held = np.array(x, float), np.array(y), np.array(held)
    model = trees.fit(x[~held], y[~held], trees=60, depth=4) if (~held).any() else trees.fit(x, y, trees=60, depth=4)
    score = model.score(x)
    seen = held if held.any() else np.ones(len(x), bool)
    threshold = {}
    for k in range(len(KINDS)):
        own = seen & (x[:, 0] == k)
        order = np.argsort(-score[own], kind="stable")
        s, right = score[own][order], y[own][order]
        good = np.flatnonzero(np.cumsum(right) >= PRECISION * np.arange(1, len(right) + 1))
        threshold[k] = max(LEAST_THRESHOLD, float(s[good[-1]])) if len(good) else np.inf
    return Judge(model, threshold)


# ---- application ---------------------------------------------------------------------------------
def _triggered(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """(row, text) of the rows whose text can hold a span at all."""
    raw, off = text_parts(batch.column("text"))
    some = count_in(TRIGGER[raw], off)
    for i in np.flatnonzero(some).tolist():
        yield i, bytes(raw[off[i] : off[i + 1]]).decode()


def spans_of(text: str, judge: Judge) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans as (kind number, start, end), in that order."""
    base = base_spans(text)
    own = sorted((KINDS.index(k), a, b) for k, spans in base.items() for a, b in spans)
    return own, sorted(own + [c[:3] for c in judge.choose(text, base)])


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind in capitals and brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "doc_id bigint, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, base and all spans, by kind and start."""
    judge = judge or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in byte_slices(batches, "text"):
            base, spans = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for i, text in _triggered(batch):
                for out, found in zip((base, spans), spans_of(text, judge), strict=True):
                    out[i] = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, item), pa.array(spans, item)], ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SPANS)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base counts by kind, the digest of the base spans, and all spans as text."""
    found = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def redacted(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """The rows of ``docs`` with all spans replaced in ``text``; ``n_chars``, where there is one, follows."""
    judge = judge or fit(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            changed: dict[int, str] = {}
            for i, text in _triggered(batch):
                if spans := spans_of(text, judge)[1]:
                    changed[i] = redact(text, spans)
            if changed:
                texts, at = batch.column("text").to_pylist(), batch.schema.get_field_index("text")
                for i, text in changed.items():
                    texts[i] = text
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                at = batch.schema.get_field_index("n_chars")
                if at >= 0:
                    sizes = batch.column(at).to_pylist()
                    for i, text in changed.items():
                        sizes[i] = len(text)
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
            yield batch.select(names)

    return docs.mapInArrow(run, docs.schema)
