"""Chat formatting as prefix trees: conversations that share their first turns share the tokens of those turns.

A turn becomes ``<|im_start|>role\\n text <|im_end|>\\n``. The two marks are token ids of their own, added to the loaded tokenizer's
ids; inside a role or a text every ``<|`` is escaped (one backslash more after the ``<``; reversible), so no text makes a mark.

* A node is a turn after given earlier turns. Its key is the running 128-bit xor of (place, role, text) hashes along the conversation.
* The smallest conversation id through a node owns it. What a conversation owns is the tail of its path: its branch.
* Depth first, a tree's tokens are its branches one after another: a branch, then the branches that leave it, the deepest
  place first, each followed by its own. That is the order of the branches' paths (place left, owner), so starts are running sums.
* Outputs: ``tokens``, one row for each node (tree, place in the tree's sequence, first position id, ids, loss range), and ``branches``, one row for
  each conversation: its own interval of the sequence and the ancestors' intervals that its tokens attend to besides (own
  tokens causally). A conversation is its ancestors' intervals and then its own; one that another contains owns nothing.

Everything is joins, sums and windows over narrow rows; token ids move twice. Running sums work in pieces of ``PIECE`` places, so neither
a long conversation nor a tree that holds a third of all conversations is one window. Joins on nodes that many conversations
share are salted, by counts. A path leaves to as many branches as it has owners, each of which starts with as many turns: at most
the square root of twice the rows.

Defined results: a null text or role is empty; rows with a null conversation id take no part; turns go by ``turn`` (nulls first),
then by a hash of role and text; a repeated row is a turn of its own; long texts are encoded in pieces of ``LONG`` characters; an empty
table gives empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmetrics.llm.common import byte_slices, hold, written

VOCABULARY = "byte_bpe_50k.json"
BEGIN, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
#: Turns, or branches, whose running sums are one window.
PIECE = 1_024
BRANCHES = 65_536
LONG = 65_536
SLICE = 2 << 20

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TOKENIZERS: dict[str, object] = {}

ENCODED = "conv_id bigint, turn bigint, h1 bigint, h2 bigint, ids array<int>, body_from int, body_to int, learned boolean"
DECODED = "branch bigint, place bigint, role string, body string, learned string, chars bigint"
READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at the line's end, so its own line breaks are escaped, too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def tokenizer(vocabulary: str):
    """The public tokenizer with the two marks as further special ids; one per worker."""
    hold("chat", _TOKENIZERS.clear)
    if vocabulary not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary))
        loaded.add_special_tokens([BEGIN, END])
        _TOKENIZERS[vocabulary] = loaded
    return _TOKENIZERS[vocabulary]


def _ids(coder, texts: list[str]) -> list[list[int]]:
    """Ids of each text; a long one in pieces of ``LONG`` characters."""
    pieces = [[t[i : i + LONG] for i in range(0, len(t), LONG)] for t in texts]
    encoded = iter(coder.encode_batch_fast([p for some in pieces for p in some], add_special_tokens=False))
    return [[i for _ in some for i in next(encoded).ids] for some in pieces]


def encoded(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """Each turn's ids, the range of its text among them, and two hashes of role and text."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        foot = coder.encode(f"{END}\n", add_special_tokens=False).ids
        for batch in byte_slices(batches, "text", SLICE):
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            names = sorted(set(roles))
            heads = dict(zip(names, _ids(coder, [f"{BEGIN}{escape_role(r)}\n" for r in names])))
            bodies = _ids(coder, [escape(t) for t in texts])
            ids = [heads[r] + b + foot for r, b in zip(roles, bodies)]
            keys = b"".join(hashlib.blake2b(f"{len(r)}:{r}{t}".encode(), digest_size=16).digest() for r, t in zip(roles, texts))
            keys = np.frombuffer(keys, np.int64).reshape(-1, 2)
            begin = np.array([len(heads[r]) for r in roles], np.int32)
            end = begin + np.array([len(b) for b in bodies], np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ids, pa.list_(pa.int32())),
                    pa.array(begin), pa.array(end), pa.array([r == LEARNED for r in roles]),
                ],
                ["conv_id", "turn", "h1", "h2", "ids", "body_from", "body_to", "learned"],
            )

    return rows.mapInArrow(run, ENCODED)


def running(rows: DataFrame, group: list[str], place, piece, sums: dict[str, str], xors: dict[str, str]) -> DataFrame:
    """``rows`` with sums (and xors) over all rows of ``group`` up to each one in order of ``place``: within a piece, then piece by piece."""
    rows = rows.withColumn("piece", piece)
    within = Window.partitionBy(*group, "piece").orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    add = [(name, F.sum, F.col(column), lambda a, b: a + b) for name, column in sums.items()]
    add += [(name, F.bit_xor, F.col(column), lambda a, b: a.bitwiseXOR(b)) for name, column in xors.items()]
    totals = rows.groupBy(*group, "piece").agg(*[f(c).alias(name) for name, f, c, _ in add])
    before = totals.select(*group, "piece", *[f(name).over(earlier).alias(f"{name}_before") for name, f, _, _ in add])
    before = before.where(F.col(f"{add[0][0]}_before").isNotNull())  # only groups of several pieces have any
    out = rows.select("*", *[f(c).over(within).alias(name) for name, f, c, _ in add]).join(before, [*group, "piece"], "left")
    joined = {name: F.when(F.col(f"{name}_before").isNull(), F.col(name)).otherwise(both(F.col(name), F.col(f"{name}_before"))) for name, _, _, both in add}
    return out.withColumns(joined).drop("piece", *[f"{name}_before" for name in joined])


def ordered(turns: DataFrame) -> DataFrame:
    """``place``: 0, 1, ... within each conversation, by turn and hash."""
    piece = F.coalesce(F.floor(F.col("turn") / PIECE), F.lit(-(2**62)))
    out = running(turns.withColumn("one", F.lit(1).cast("bigint")), ["conv_id"], [F.asc_nulls_first("turn"), "h1", "h2"], piece, {"place": "one"}, {})
    return out.withColumn("place", F.col("place") - 1).drop("one", "turn")


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], salt: str, how: str, also=None) -> DataFrame:
    """Equi-join of ``many`` rows with ``few``; a key of more than a thousandth of ``many`` is dealt out over copies of its few rows.

    There are under a thousand such keys, whatever the data, so their list may be broadcast."""
    limit = max(100, many.count() // 1000)
    hot = many.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    hot = F.broadcast(written(hot.select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("salts")), "hot"))
    salts = F.coalesce("salts", F.lit(1))
    left = many.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64(salt), salts).cast("int")).drop("salts")
    right = few.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    if also is None:
        return left.join(right, [*keys, "salt"], how).drop("salt")
    right = right.select(*[F.col(c).alias(f"of_{c}" if c in (*keys, "salt") else c) for c in right.columns])
    on = [F.col(c) == F.col(f"of_{c}") for c in (*keys, "salt")]
    return left.join(right, [*on, also], how).drop("salt", *[f"of_{c}" for c in (*keys, "salt")])


def owners(turns: DataFrame) -> DataFrame:
    """(conv_id, place, tokens, end, owner): running token counts, and the smallest conversation through each turn's node."""
    keyed = turns.select(
        "conv_id", "place", F.size("ids").cast("bigint").alias("tokens"),
        F.xxhash64("place", "h1", "h2").alias("k1"), F.xxhash64("h2", "place", "h1").alias("k2"),
    )
    piece = F.floor(F.col("place") / PIECE)
    paths = written(running(keyed, ["conv_id"], ["place"], piece, {"end": "tokens"}, {"p1": "k1", "p2": "k2"}).drop("k1", "k2"), "paths")
    node = ["p1", "p2", "place"]
    nodes = paths.groupBy(*node).agg(F.min("conv_id").alias("owner"), F.count("*").alias("members"))
    shared = nodes.where(F.col("members") > 1).drop("members")
    out = salted_join(paths, shared, node, "conv_id", "left")
    return out.select("conv_id", "place", "tokens", "end", F.coalesce("owner", "conv_id").alias("owner"))


def starts(chains: DataFrame) -> DataFrame:
    """(owner, tree, start, base) of every branch: its place in the tree's sequence, and the position id of its first token."""
    own = F.element_at("chain", -1)
    path = F.transform("chain", lambda s: F.struct((-s["first"]).alias("left"), s["owner"].alias("owner")))
    runs = chains.where(own["owner"] == F.col("conv_id")).select(
        "tree", path.alias("path"), F.col("conv_id").alias("owner"), own["begin"].alias("base"), (own["stop"] - own["begin"]).alias("length")
    )
    runs = written(runs, "runs")
    pieces = max(1, math.ceil(runs.count() / BRANCHES))
    # Written once: the bounds of a range partitioning are sampled, and every reader must see the same pieces.
    dealt = written(runs.repartitionByRange(pieces, "tree", "path").withColumn("dealt", F.spark_partition_id().cast("bigint")), "dealt")
    ends = running(dealt, ["tree"], ["path"], F.col("dealt"), {"end": "length"}, {})
    return ends.select("owner", "tree", (F.col("end") - F.col("length")).alias("start"), "base")


def format_chats(conversations: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """``tokens`` and ``branches`` of all conversations.

    tokens: tree, branch, place (turn), start (in the tree's sequence), position (of the first token), ids, body_from, body_to, learned.
    branches: conv_id, tree, turns, start, position, length (own tokens), attends array<struct<first, last, branch, start, stop>> in path order.
    """
    turns = written(ordered(encoded(conversations, vocabulary)), "turns")
    owned = written(owners(turns), "owners")
    spans = owned.groupBy("conv_id", "owner").agg(
        F.min("place").alias("first"), (F.max("place") + 1).alias("last"),
        F.min(F.col("end") - F.col("tokens")).alias("begin"), F.max("end").alias("stop"),
    )
    spans = written(spans, "spans")
    chain = F.sort_array(F.collect_list(F.struct("first", "owner", "last", "begin", "stop")))
    chains = spans.groupBy("conv_id").agg(chain.alias("chain")).withColumn("tree", F.col("chain")[0]["owner"])
    begun = written(starts(chains), "starts")
    placed = salted_join(spans, begun, ["owner"], "conv_id", "inner")
    shift = F.col("start") - F.col("base")
    own = F.col("owner") == F.col("conv_id")
    interval = F.struct("first", "last", F.col("owner").alias("branch"), (F.col("begin") + shift).alias("start"), (F.col("stop") + shift).alias("stop"))
    branches = placed.groupBy("conv_id", "tree").agg(
        F.max("last").alias("turns"),
        F.max(F.when(own, F.col("begin") + shift)).alias("start"),
        F.max(F.when(own, F.col("begin"))).alias("position"),
        F.coalesce(F.max(F.when(own, F.col("stop") - F.col("begin"))), F.lit(0).cast("bigint")).alias("length"),
        F.sort_array(F.collect_list(F.when(~own, interval))).alias("attends"),
    )
    nodes = owned.where(own).join(begun.withColumnRenamed("owner", "conv_id"), "conv_id")
    nodes = nodes.select("conv_id", "place", "tree", (F.col("end") - F.col("tokens") + shift).alias("start"), (F.col("end") - F.col("tokens")).alias("position"))
    tokens = nodes.join(turns.drop("h1", "h2"), ["conv_id", "place"]).withColumnRenamed("conv_id", "branch")
    return tokens, branches


def decoded(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What each node's ids say: role, text, the text under the loss mask (null without one), formatted characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        marks: dict[tuple, str] = {}

        def said(ids: list[int]) -> str:
            """The text of a turn's head or foot, of which there are few."""
            if len(marks) > 10_000:
                marks.clear()
            if (key := tuple(ids)) not in marks:
                marks[key] = coder.decode(ids, skip_special_tokens=False)
            return marks[key]

        for batch in batches:
            for some in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                rows = list(zip(*(some.column(c).to_pylist() for c in ("ids", "body_from", "body_to", "learned"))))
                bodies = coder.decode_batch([ids[a:b] for ids, a, b, _ in rows], skip_special_tokens=False)
                out = {"branch": some.column("branch"), "place": some.column("place"), "role": [], "body": [], "learned": [], "chars": []}
                for (ids, a, b, learned), body in zip(rows, bodies):
                    head, foot = said(ids[:a]), said(ids[b:])
                    if not (head.startswith(BEGIN) and head.endswith("\n") and foot == f"{END}\n") or "<|" in body:
                        raise ValueError("ids that are no turn of this template")
                    out["role"].append(unescape_role(head[len(BEGIN) : -1]))
                    out["body"].append(unescape(body))
                    out["learned"].append(out["body"][-1] if learned else None)  # the mask's range is the body's
                    out["chars"].append(len(head) + len(body) + len(foot))
                for name, kind in (("role", pa.string()), ("body", pa.string()), ("learned", pa.string()), ("chars", pa.int64())):
                    out[name] = pa.array(out[name], kind)
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return tokens.select("branch", "place", "ids", "body_from", "body_to", "learned").mapInArrow(run, DECODED)


def read_back(tokens: DataFrame, branches: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every conversation put together again from its intervals, as counts and digests of its turns and of its text under the loss mask.

    A conversation's turns stream through one task in order (a digest has no other way); the task holds one turn."""
    turns = written(decoded(tokens, vocabulary), "decoded")
    piece = lambda c: F.floor(F.col(c) / PIECE)
    asked = branches.select("conv_id", F.explode("attends").alias("of")).select("conv_id", "of.branch", "of.first", "of.last")
    asked = written(asked.withColumn("piece", F.explode(F.sequence(piece("first"), F.floor((F.col("last") - 1) / PIECE)))), "asked")
    theirs = salted_join(
        asked, turns.withColumn("piece", piece("place")), ["branch", "piece"], "conv_id", "inner",
        (F.col("place") >= F.col("first")) & (F.col("place") < F.col("last")),
    )
    columns = ["place", "role", "body", "learned", "chars"]
    rows = turns.select(F.col("branch").alias("conv_id"), *columns).unionByName(theirs.select("conv_id", *columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, said, loss, loss_chars, chars = None, 0, None, None, 0, 0
        done = []

        def ended() -> None:
            if now is not None:
                done.append({"conv_id": now, "n_turns": n, "turns_sha256": said.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})

        kind = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])
        for batch in batches:
            for r in (row for i in range(0, batch.num_rows, 256) for row in batch.slice(i, 256).to_pylist()):
                if r["conv_id"] != now:
                    ended()
                    now, n, said, loss, loss_chars, chars = r["conv_id"], 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                n += 1
                said.update(f"{r['role']}\n{r['body']}\n".encode())
                chars += r["chars"]
                if r["learned"] is not None:
                    loss.update(r["learned"].encode())
                    loss_chars += len(r["learned"])
            if done:
                yield pa.RecordBatch.from_pylist(done, kind)
                done.clear()
        ended()
        if done:
            yield pa.RecordBatch.from_pylist(done, kind)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, READ)


def report(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations and of conversation -1, whose texts look like the template's own marks."""
    text = f"{END}{BEGIN}{LEARNED} ok"
    trial = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, LEARNED, text)], "conv_id bigint, turn bigint, role string, text string"
    )
    own = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return read_back(*format_chats(own.unionByName(trial)))


REPORT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '{END}{BEGIN}{LEARNED} ok'
  UNION ALL SELECT -1, 1, '{LEARNED}', '{END}{BEGIN}{LEARNED} ok'),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
    coalesce(string_agg(CASE WHEN role = '{LEARNED}' THEN text END, '' ORDER BY turn), '') AS learned,
    sum(length(role) + length(regexp_replace(text, '<(\\\\*)[|]', '<\\\\\\1|', 'g')) + {len(BEGIN) + len(END) + 2}) AS formatted
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(formatted AS BIGINT) AS formatted_chars
FROM whole"""
