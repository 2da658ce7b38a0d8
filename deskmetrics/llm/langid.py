"""Language ID: interpolated Kneser-Ney character language models, one per language.

A text's words (runs of letters, in lower case) are scored as character sequences with a start and
an end mark. For every n-gram up to ``ORDER`` that any language has met, the interpolated probability in
each language is worked out once, from Kneser-Ney counts; so is the back-off weight of every context. They
lie in arrays sorted by the n-gram's 64-bit hash, one row for all languages: scoring a character
is a binary search and, on a miss, one step down. Each distinct word is scored once in a worker
and remembered; a text's cross-entropy is the sum over its words by the number of characters.

The language with the lowest cross-entropy is the prediction. Rejection is calibrated on rows that
the counts leave out: they give the mean and deviation of a character's surprisal in its own
language, and a text is rejected when its cross-entropy lies more than ``TOLERANCE`` standard
errors plus ``SLACK`` nats above. The standard error shrinks with the text's length, so short texts get room.

Counts come from all learnable documents, each distinct text of a language once; one text in ``CALIBRATE_EACH`` is for
calibration instead. Words, n-grams, continuation counts and discounts are aggregates on Spark. The n-gram table is
measured first: up to ``MODEL_BYTES`` it is put together on the driver and broadcast (``Model``); beyond, it stays a table,
and blocks of distinct words meet the n-grams that they need (``Spread``), with the same results. Ids, sources and the language
column are never inputs of a prediction.

Defined results: ``und`` with score 0 for a null text or one without letters, and for all texts when
nothing was learned; ties go to the language first in order; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm.common import binary_array, byte_slices, hold, release, text_parts, written

ORDER = 5
#: One distinct text in so many is for calibration and not counted.
CALIBRATE_EACH = 6
FOLDS = 3
HELD_OUT = 1
TOLERANCE = 6.0
SLACK = 1.2
#: Hashes of up to so many repeated texts are broadcast to find their rows; beyond, the join is shuffled.
BROADCAST_HASHES = 1_000_000
#: A model of at most so many bytes of n-grams and contexts is broadcast; beyond, it is joined.
MODEL_BYTES = 160 << 20
#: Distinct words that meet their n-grams at once when the model is joined.
BLOCK_WORDS = 20_000
#: Words a worker remembers.
MEMO_WORDS = 150_000
#: Nats by which the score's logistic falls off around the rejection line.
SOFTNESS = 0.1
#: A text counts as at most so many characters when the languages' odds are taken.
ODDS_CHARS = 60

START, END = 1, 2
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LETTER[128:] = True


def letter_runs(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Runs of ASCII letters and non-ASCII bytes: owner text, number of the distinct run, the distinct runs (ASCII in lower case)."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    own = np.zeros(len(raw) + 1, bool)
    own[:-1] = _LETTER[raw]
    starts = np.zeros(len(raw) + 1, bool)
    starts[off] = True
    first = np.flatnonzero(own[:-1] & (np.append(True, ~own[:-2]) | starts[:-1])) if len(raw) else np.zeros(0, np.int64)
    last = np.flatnonzero(own[:-1] & (~own[1:] | starts[1:])) + 1 if len(raw) else np.zeros(0, np.int64)
    doc = np.searchsorted(off, first, side="right") - 1
    both = np.append(np.stack([first, last], 1).ravel(), len(raw)).astype(np.int64)
    if not len(first):
        return doc, np.zeros(0, np.int64), pa.array([], pa.large_binary())
    runs = binary_array(low, both).take(pa.array(np.arange(0, len(both) - 1, 2)))
    coded = runs.dictionary_encode()
    return doc, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def words_of(run: bytes) -> str:
    """A run's letters in lower case; anything else in it becomes a blank between words."""
    text = run.decode().lower()
    return text if text.isalpha() else "".join(c if c.isalpha() else " " for c in text).strip()


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words with their marks; owner word; place in the word. A blank ends and starts a word."""
    text = "".join(f"\x01{w.replace(' ', chr(2) + chr(1))}\x02" for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 + w.count(" ") for w in words])
    opens = np.flatnonzero(code == START)
    place = np.arange(len(code)) - opens[np.cumsum(code == START) - 1]
    return code, owner, place


def _hashes(code: np.ndarray) -> list[np.ndarray]:
    """h[n][i]: hash of the n symbols that end at i."""
    mul, mix = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
    out = [np.zeros(len(code), np.uint64)]
    with np.errstate(over="ignore"):
        one = (code + np.uint64(1)) * mul
        one ^= one >> np.uint64(29)
        one *= mix
        for _ in range(ORDER):
            before = np.append(np.uint64(0), out[-1][:-1])
            now = (before ^ (before >> np.uint64(31))) * mul + one
            out.append(now ^ (now >> np.uint64(30)))
    return out


@dataclass
class Model:
    """Sorted n-gram and context hashes with one row of log-probabilities or log-weights for all languages."""

    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weight: list[np.ndarray] = field(default_factory=list)
    unseen: float = -12.0
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each word in each language, and the symbols it was summed over."""
        total = np.zeros((len(words), len(self.langs)))
        if not any(words):
            return total, np.zeros(len(words), np.int64)
        code, owner, place = _symbols(words)
        hashes = _hashes(code)
        alive = np.flatnonzero(place > 0)
        logs = np.zeros((len(code), len(self.langs)), np.float32)
        for n in range(ORDER, 0, -1):
            fits = place[alive] >= n - 1
            at = alive[fits]
            found, row = _find(self.grams[n], hashes[n][at])
            logs[at[found]] += self.logp[n][row[found]]
            missed = at[~found]
            if n > 1:
                known, row = _find(self.contexts[n], hashes[n - 1][missed - 1])
                logs[missed[known]] += self.weight[n][row[known]]
            else:
                logs[missed] += self.unseen
            alive = np.concatenate([alive[~fits], missed])
        for j in range(len(self.langs)):
            total[:, j] = np.bincount(owner, logs[:, j], len(words))
        count = np.bincount(owner[place > 0], minlength=len(words))
        empty = np.array([not w for w in words])
        total[empty], count[empty] = 0, 0
        return total, count


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(keys, wanted)
    row[row == len(keys)] = 0
    return (keys[row] == wanted if len(keys) else np.zeros(len(wanted), bool)), row


def kneser_ney(counts: list[tuple[str, str, int]]) -> Model:
    """The model of (language, word, count) rows, in one place; ``fit`` has the same counts from Spark."""
    langs = sorted({lang for lang, _, _ in counts})
    model = Model(langs, [np.zeros(0, np.uint64)], [np.zeros((0, len(langs)))], [np.zeros(0, np.uint64)] * 2, [np.zeros((0, len(langs)))] * 2)
    if not langs:
        return model
    code, owner, place = _symbols([w for _, w, _ in counts])
    lang = np.searchsorted(langs, [a for a, _, _ in counts])[owner]
    often = np.array([c for _, _, c in counts], float)[owner]
    hashes = _hashes(code)
    vocabulary = len(np.unique(code[place > 0])) + 1
    model.unseen = float(-np.log(vocabulary * 50))
    lower = None
    for n in range(1, ORDER + 1):
        at = np.flatnonzero((place >= max(n - 1, 1)))
        grams, rep, gram = np.unique(hashes[n][at], return_index=True, return_inverse=True)
        count = np.zeros((len(grams), len(langs)))
        if n == ORDER:
            np.add.at(count, (gram, lang[at]), often[at])
        else:
            # Distinct left neighbours; n-grams at a word's start have none and keep their counts.
            head = place[at] == n - 1
            np.add.at(count, (gram[head], lang[at][head]), often[at][head])
            inner = np.flatnonzero(~head)
            left = hashes[n + 1][at[inner]]
            _, one = np.unique(left ^ (lang[at[inner]].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
            np.add.at(count, (gram[inner[one]], lang[at[inner[one]]]), 1)
        once, twice = (count == 1).sum(0), (count == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        if n == 1:
            total = np.maximum(count.sum(0), 1)
            kinds = (count > 0).sum(0)
            p = np.maximum(count - discount, 0) / total + discount * np.maximum(kinds, 1) / total / vocabulary
            p = np.maximum(p, 1 / (vocabulary * 50))
        else:
            first = at[rep]
            contexts, context = np.unique(hashes[n - 1][first - 1], return_inverse=True)
            total = np.zeros((len(contexts), len(langs)))
            kinds = np.zeros_like(total)
            np.add.at(total, context, count)
            np.add.at(kinds, context, count > 0)
            spread = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            found, row = _find(model.grams[n - 1], hashes[n - 1][first])
            p = np.where(total[context] > 0, np.maximum(count - discount, 0) / np.maximum(total[context], 1), 0) + spread[context] * lower[row]
            model.contexts.append(contexts)
            model.weight.append(np.log(spread).astype(np.float32))
        model.grams.append(grams)
        model.logp.append(np.log(p).astype(np.float32))
        lower = p
    return model


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(
        (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT)
        & F.col("lang").isNotNull()
        & F.col("text").isNotNull()
    )


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, calibration, word, n): what a slice adds to the counts of a language's two parts."""
    for batch in byte_slices(batches, "text"):
        raw, off = text_parts(batch.column("text"))
        doc, code, runs = letter_runs(raw, off)
        if not len(code):
            continue
        words = [words_of(r) for r in runs.to_pylist()]
        langs, of_lang = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        part = batch.column("calibration").to_numpy(zero_copy_only=False)
        group = (of_lang * 2 + part)[doc]
        pair, n = np.unique(group * len(words) + code, return_counts=True)
        group, code = pair // len(words), pair % len(words)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs[group // 2].tolist(), pa.string()),
                pa.array(group % 2 == 1),
                pa.array(words, pa.string()).take(pa.array(code)),
                pa.array(n.astype(np.int64)),
            ],
            ["lang", "calibration", "word", "n"],
        )


def word_table(docs: DataFrame) -> DataFrame:
    """(lang, calibration, word, n) over all learnable documents, each distinct text of a language once."""
    own = learnable(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"))
    own = own.select("lang", "text", F.xxhash64("text").alias("h"))
    again = written(own.groupBy("lang", "h").count().where("count > 1").select("lang", "h"), "repeated")
    few = F.broadcast(again) if again.count() <= BROADCAST_HASHES else again
    # Only texts whose hash comes again are shuffled, and their copies combine on the map side.
    texts = own.join(few, ["lang", "h"], "left_anti").select("lang", "text")
    texts = texts.union(own.join(few, ["lang", "h"], "left_semi").select("lang", "text").distinct())
    texts = texts.withColumn("calibration", F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(CALIBRATE_EACH)) == 0)
    words = texts.mapInArrow(_word_counts, "lang string, calibration boolean, word string, n bigint").where("word != ''")
    return written(words.groupBy("lang", "calibration", "word").agg(F.sum("n").alias("n")), "words")


def _marked(word: Column) -> Column:
    return F.concat(F.lit(chr(START)), word, F.lit(chr(END)))


def _parts(text: Column, size: int) -> Column:
    """All parts of ``size`` neighbouring characters."""
    none = F.array().cast("array<string>")
    return F.when(F.length(text) < size, none).otherwise(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size))))


def gram_table(words: DataFrame) -> DataFrame:
    """(lang, gram, n) of all orders from (lang, word, n): counts of the highest order and at a word's start, else distinct left neighbours."""
    one = words.select("lang", "n", F.explode(F.split("word", " ")).alias("w")).select("lang", "n", _marked(F.col("w")).alias("w"))
    starts = F.filter(F.transform(F.sequence(F.lit(2), F.lit(ORDER - 1)), lambda k: F.substring("w", F.lit(1), k)), lambda g, k: F.length(g) == k + 2)
    counts = one.select("lang", "n", F.explode(F.concat(_parts(F.col("w"), ORDER), starts)).alias("gram"))
    counts = written(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    level = counts.where(F.length("gram") == ORDER)
    out = level
    for size in range(ORDER - 1, 0, -1):
        inner = level.select("lang", F.substring("gram", F.lit(2), F.lit(size)).alias("gram"), F.lit(1).cast("bigint").alias("n"))
        level = counts.where(F.length("gram") == size).union(inner).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        level = written(level, "grams")
        out = out.union(level)
    return out


def _hash_of(grams: list[str], size: int) -> list[np.ndarray]:
    """Hashes of texts of ``size`` characters: whole, without the last, without the first."""
    code = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64)
    hashes = _hashes(code)
    if size < 2:
        return [hashes[size][size - 1 :: size]]
    return [hashes[size][size - 1 :: size], hashes[size - 1][size - 2 :: size], hashes[size - 1][size - 1 :: size]]


def assemble(langs: list[str], sums: dict[int, np.ndarray], vocabulary: int, grams: pa.Table, contexts: pa.Table) -> Model:
    """The model of (lang, gram, n) and (lang, context, n, kinds) rows. ``sums``: for each order n-grams met once,
    met twice, their total and their number, in each language of the whole table."""
    model = Model(langs, [np.zeros(0, np.uint64)], [np.zeros((0, len(langs)))], [np.zeros(0, np.uint64)] * 2, [np.zeros((0, len(langs)))] * 2)
    model.unseen = float(-np.log(vocabulary * 50))

    def of_size(rows: pa.Table, text: str, size: int, values: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        rows = rows.filter(pc.equal(pc.utf8_length(rows.column(text)), size))
        coded = rows.column(text).combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        hashes = _hash_of(coded.dictionary.to_pylist(), size)
        order = np.argsort(hashes[0], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        lang = pc.index_in(rows.column("lang"), value_set=pa.array(langs, pa.string())).to_numpy().astype(np.int64)
        out = []
        for name in values:
            out.append(np.zeros((len(order), len(langs))))
            out[-1][at, lang] = rows.column(name).to_numpy()
        return [h[order] for h in hashes], out

    lower = None
    for n in range(1, ORDER + 1):
        once, twice, all_, some = sums.get(n, np.zeros((4, len(langs))))
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        hashes, (count,) = of_size(grams, "gram", n, ["n"])
        if n == 1:
            total = np.maximum(all_, 1)
            p = np.maximum(count - discount, 0) / total + discount * np.maximum(some, 1) / total / vocabulary
            p = np.maximum(p, 1 / (vocabulary * 50))
        else:
            (keys, *_), (total, kinds) = of_size(contexts, "context", n - 1, ["n", "kinds"])
            spread = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            context, shorter = _find(keys, hashes[1])[1], _find(model.grams[n - 1], hashes[2])[1]
            p = np.where(total[context] > 0, np.maximum(count - discount, 0) / np.maximum(total[context], 1), 0) + spread[context] * lower[shorter]
            model.contexts.append(keys)
            model.weight.append(np.log(spread).astype(np.float32))
        model.grams.append(hashes[0])
        model.logp.append(np.log(p).astype(np.float32))
        lower = p
    return model


@dataclass
class Spread:
    """A model whose n-grams stay in tables: what ``assemble`` takes besides them, and the calibration."""

    langs: list[str]
    sums: dict[int, np.ndarray]
    vocabulary: int
    grams: DataFrame
    contexts: DataFrame
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None


def fit(docs: DataFrame) -> Model | Spread:
    """The model of all learnable documents; the held-out fold is left out."""
    words = word_table(docs)
    there = words.groupBy("lang").agg(F.min("calibration").alias("uncounted"), F.max("calibration").alias("held")).collect()
    langs = sorted(r["lang"] for r in there)
    if not langs:
        return kneser_ney([])
    # A language all of whose texts fell to the calibration is counted from those.
    counted = words.where(~F.col("calibration") | F.col("lang").isin([r["lang"] for r in there if r["uncounted"]]))
    grams = gram_table(counted.select("lang", "word", "n"))
    size = F.length("gram")
    contexts = grams.where(size > 1).groupBy("lang", F.substring("gram", F.lit(1), size - 1).alias("context"))
    contexts = written(contexts.agg(F.sum("n").alias("n"), F.count("*").alias("kinds")), "contexts")
    sums = {n: np.zeros((4, len(langs))) for n in range(1, ORDER + 1)}
    met = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.sum("n"), F.count("*")]
    for r in grams.groupBy(size.alias("size"), "lang").agg(*[c.alias(f"c{i}") for i, c in enumerate(met)]).collect():
        sums[r["size"]][:, langs.index(r["lang"])] = [r[f"c{i}"] for i in range(4)]
    vocabulary = grams.where(size == 1).select("gram").distinct().count() + 1
    rows = grams.select("gram").distinct().count() + contexts.select("context").distinct().count()
    if rows * (8 + 4 * len(langs)) <= MODEL_BYTES:
        model = assemble(langs, sums, vocabulary, grams.toArrow(), contexts.toArrow())
    else:
        model = Spread(langs, sums, vocabulary, grams, contexts)
    _calibrate(model, words.where("calibration") if any(r["held"] for r in there) else words)
    release()  # the driver outlives the fit
    return model


def scored(rows: DataFrame, model: Model | Spread) -> DataFrame:
    """``rows`` with their word's log-likelihood in each language and the symbols it was summed over."""
    schema = ", ".join([*(f"`{name}` {kind}" for name, kind in rows.dtypes), "total array<double>, symbols bigint"])

    def added(table, own: Model):
        total, count = own.words(table.column("word").to_pylist())
        ends = pa.array(np.arange(len(count) + 1, dtype=np.int32) * len(own.langs), pa.int32())
        more = [pa.ListArray.from_arrays(ends, pa.array(total.ravel())), pa.array(count.astype(np.int64))]
        return type(table).from_arrays([*table.columns, *more], [*table.schema.names, "total", "symbols"])

    if isinstance(model, Model):
        sent, _ = _shared(rows, model)
        return rows.mapInArrow(lambda batches: (added(batch, sent.value) for batch in batches if batch.num_rows), schema)

    blocks = max(1, -(-rows.select("word").distinct().count() // BLOCK_WORDS))
    block = F.pmod(F.xxhash64("word"), F.lit(blocks)).alias("block")
    own = rows.select("word").distinct().select(block, F.explode(F.split("word", " ")).alias("w")).select("block", _marked(F.col("w")).alias("w"))
    needed = own.select("block", F.explode(F.concat(*[_parts(F.col("w"), k) for k in range(1, ORDER + 1)])).alias("gram")).distinct()
    grams = needed.join(model.grams, "gram").select("block", F.lit(False).alias("context"), "lang", "gram", "n", F.lit(0).cast("bigint").alias("kinds"))
    contexts = model.contexts.withColumnRenamed("context", "gram")
    contexts = needed.join(contexts, "gram").select("block", F.lit(True).alias("context"), "lang", "gram", "n", "kinds")
    langs, sums, vocabulary = model.langs, model.sums, model.vocabulary

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_context = right.column("context")
        grams = right.filter(pc.invert(is_context)).select(["lang", "gram", "n"])
        contexts = right.filter(is_context).select(["lang", "gram", "n", "kinds"]).rename_columns(["lang", "context", "n", "kinds"])
        return added(left.drop_columns(["block"]), assemble(langs, sums, vocabulary, grams, contexts))

    return rows.withColumn("block", block).groupBy("block").cogroup(grams.union(contexts).groupBy("block")).applyInArrow(run, schema)


def _calibrate(model: Model | Spread, held: DataFrame) -> None:
    """Mean and deviation of a character's surprisal in its own language; over all languages where one has no rows."""
    n = len(model.langs)
    own = -F.get("total", F.array_position(F.array(*[F.lit(x) for x in model.langs]), F.col("lang")).cast("int") - 1)
    rows = scored(held.select("lang", "word", "n"), model).where("symbols > 0").select("lang", "n", F.col("symbols").cast("double").alias("c"), own.alias("own"))
    powers = [F.col("c"), F.col("own"), F.col("own") * F.col("own"), F.col("own") * F.col("c"), F.col("c") * F.col("c")]
    parts = np.zeros((n, len(powers)))
    for r in rows.groupBy("lang").agg(*[F.sum(F.col("n") * x).alias(f"s{i}") for i, x in enumerate(powers)]).collect():
        parts[model.langs.index(r["lang"])] = [r[f"s{i}"] for i in range(len(powers))]
    parts = np.where(parts[:, :1] > 0, parts, parts.sum(0))
    chars = np.maximum(parts[:, 0], 1)
    mean = parts[:, 1] / chars
    spread = (parts[:, 2] - 2 * mean * parts[:, 3] + mean**2 * parts[:, 4]) / chars
    # Rounded: sums over tasks come in any order.
    model.mean, model.deviation = mean.round(9), np.sqrt(np.maximum(spread, 1e-6)).round(9)


class Words:
    """Scores of the words that a worker has met."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.total = np.zeros((0, len(self.model.langs)))
        self.count = np.zeros(0, np.int64)

    def look(self, runs: list[bytes]) -> np.ndarray:
        if len(self.place) > MEMO_WORDS:
            self.clear()
        new = [r for r in runs if r not in self.place]
        if new:
            total, count = self.model.words([words_of(r) for r in new])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.total, self.count = np.concatenate([self.total, total]), np.append(self.count, count)
        return np.fromiter((self.place[r] for r in runs), np.int64, len(runs))


def verdict(model: Model | Spread, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text, from its symbols and log-likelihoods: number of the language (-1: und), score, accepted."""
    cross = -total / np.maximum(count, 1)[:, None]
    best = cross.argmin(1)
    odds = np.exp(-(cross - cross.min(1, keepdims=True)) * np.minimum(count, ODDS_CHARS)[:, None])
    line = model.mean[best] + TOLERANCE * model.deviation[best] / np.sqrt(np.maximum(count, 1)) + SLACK
    room = (line - cross[np.arange(len(count)), best]) / SOFTNESS
    score = 1 / odds.sum(1) / (1 + np.exp(-np.clip(room, -30, 30)))
    some = count > 0
    return np.where(some, best, -1), np.where(some, score, 0.0), some & (room >= 0)


def predict(words: Words, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: number of the language (-1: und), score, accepted."""
    model, n = words.model, len(off) - 1
    if not model.langs:
        return np.full(n, -1), np.zeros(n), np.zeros(n, bool)
    doc, code, runs = letter_runs(raw, off)
    place = words.look(runs.to_pylist())[code] if len(code) else np.zeros(0, np.int64)
    count = np.bincount(doc, words.count[place], n)
    return verdict(model, count, np.stack([np.bincount(doc, words.total[place, j], n) for j in range(len(model.langs))], 1))


_WORDS: dict[str, Words] = {}


def _words(key: str, model: Model) -> Words:
    """The memory of this Python worker for one fitted model, kept from task to task."""
    hold("langid", _WORDS.clear)
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(model)
    return _WORDS[key]


def _shared(docs: DataFrame, model: Model):
    """The model as a broadcast; its size was measured against ``MODEL_BYTES``."""
    return docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex


_VERDICT = "lang_pred string, score double, accepted boolean"


def _verdicts(model: Model | Spread, count: np.ndarray, total: np.ndarray) -> list[pa.Array]:
    best, score, accepted = verdict(model, count, total)
    names = pa.array([*model.langs, "und"])
    return [names.take(pa.array(np.where(best < 0, len(names) - 1, best))), pa.array(score), pa.array(accepted)]


def _row_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, word, n): the words of each row."""
    for batch in byte_slices(batches, "text"):
        doc, code, runs = letter_runs(*text_parts(batch.column("text")))
        words = pa.array([words_of(r) for r in runs.to_pylist()], pa.string())
        pair, n = np.unique(doc * max(len(words), 1) + code, return_counts=True)
        doc, code = pair // max(len(words), 1), pair % max(len(words), 1)
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(doc)), words.take(pa.array(code)), pa.array(n.astype(np.int64))], ["row", "word", "n"])


def _joined(rows: DataFrame, model: Spread) -> DataFrame:
    """row, lang_pred, score, accepted of (row, text) rows that are written: distinct words are scored, then joined."""
    words = written(rows.mapInArrow(_row_words, "row bigint, word string, n bigint").where("word != ''"), "row-words")
    known = written(scored(words.select("word").distinct(), model), "scores")
    sums = [F.sum(F.get("total", F.lit(j)) * F.col("n")).alias(f"t{j}") for j in range(len(model.langs))]
    sums = words.join(known, "word").groupBy("row").agg(F.sum(F.col("symbols") * F.col("n")).alias("symbols"), *sums)
    few = Spread(model.langs, {}, 0, None, None, model.mean, model.deviation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = np.stack([batch.column(f"t{j}").fill_null(0).to_numpy(zero_copy_only=False) for j in range(len(few.langs))], 1)
                count = batch.column("symbols").fill_null(0).to_numpy(zero_copy_only=False).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column("row"), *_verdicts(few, count, total)], ["row", "lang_pred", "score", "accepted"])

    return rows.select("row").join(sums, "row", "left").mapInArrow(run, f"row bigint, {_VERDICT}")


def _numbered(docs: DataFrame) -> DataFrame:
    row = f"row_{uuid.uuid4().hex}"  # documents may have a column of any name
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered").select(F.col(row).alias("row"), F.struct(*docs.columns).alias("doc"))


def identify(docs: DataFrame, model: Model | Spread | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score, accepted."""
    model = model or fit(docs)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT
    columns = ["doc_id", held.alias("held_out"), "lang_pred", "score", "accepted"]
    if isinstance(model, Spread):
        own = _numbered(own).select("row", "doc.*")
        return own.select("row", "doc_id").join(_joined(own.select("row", "text"), model), "row").select(*columns)
    sent, key = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(key, sent.value)
        names = pa.array([*sent.value.langs, "und"])
        for batch in byte_slices(batches, "text"):
            best, score, accepted = predict(words, *text_parts(batch.column("text")))
            lang = names.take(pa.array(np.where(best < 0, len(names) - 1, best)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lang, pa.array(score), pa.array(accepted)], ["doc_id", "lang_pred", "score", "accepted"]
            )

    return own.mapInArrow(run, f"doc_id bigint, {_VERDICT}").select(*columns)


def keep_known(docs: DataFrame, model: Model | Spread | None = None) -> DataFrame:
    """The rows of ``docs``, whole, whose text is accepted as one of the learned languages."""
    model = model or fit(docs)
    names = docs.columns
    if isinstance(model, Spread):
        own = _numbered(docs)
        kept = _joined(own.select("row", F.col("doc.text").alias("text")), model).where("accepted").select("row")
        return own.join(kept, "row", "left_semi").select("doc.*").select(names)
    sent, key = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(key, sent.value)
        for batch in byte_slices(batches, "text"):
            _, _, accepted = predict(words, *text_parts(batch.column("text")))
            yield batch.filter(pa.array(accepted)).select(names)

    return docs.mapInArrow(run, docs.schema)
