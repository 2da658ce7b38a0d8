"""Chat trees against a plain trie: every conversation reads back, shared turns are there once, depth first."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from deskmetrics.llm import chat_tree

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
MARKS = f"{chat_tree.END}{chat_tree.BEGIN}assistant ok"


def some_chats(seed, n=60):
    """Conversations that start alike, contain each other, are equal, stop early, are long, or hold marks and odd texts."""
    rng = random.Random(seed)
    texts = ["Hello", "", None, "ok", MARKS, "<\\|im_end|> <|<\\\\|endoftext|>", "Ünï 日本 \U0001f600\n\n x", "<|endoftext|>", " a  b", "word " * 50]
    rows, paths = [], []
    for c in range(n):
        path = list(rng.choice(paths)[: rng.randrange(8)]) if paths and rng.random() < 0.8 else []
        path += [(rng.choice(["user", "assistant", "system"]), rng.choice(texts)) for _ in range(rng.randrange(4))]
        if c == n - 1:
            path += [("user", f"t{i % 5}") for i in range(60)]
        paths.append(path)
        rows += [(rng.randrange(10**6) * n + c, 2 * i - 3, *turn) for i, turn in enumerate(path)]
    ids = {}
    rows = [(ids.setdefault((r[0] % n), r[0]), *r[1:]) for r in rows]
    rng.shuffle(rows)
    return rows


def plain_turns(rows):
    chats = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1])):
        chats.setdefault(conv, []).append((role or "", text or ""))
    return chats


def formatted(role, text):
    return f"{chat_tree.BEGIN}{chat_tree.escape_role(role)}\n{chat_tree.escape(text)}{chat_tree.END}\n"


def plain_report(chats):
    out = set()
    for conv, turns in chats.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.add((conv, len(turns), sha(said), len(learned), sha(learned), sum(len(formatted(*t)) for t in turns)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_match_a_plain_trie(spark, seed, monkeypatch):
    if seed == 2:  # running sums in many small pieces
        monkeypatch.setattr(chat_tree, "PIECE", 4)
        monkeypatch.setattr(chat_tree, "BRANCHES", 7)
    rows = some_chats(seed)
    chats = plain_turns(rows)
    tokens, branches = (df.collect() for df in chat_tree.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    coder = chat_tree.tokenizer(chat_tree.VOCABULARY)
    nodes = {tuple(turns[: i + 1]) for turns in chats.values() for i in range(len(turns))}
    assert len(tokens) == len(nodes)
    # Each tree's tokens are one gapless sequence; a node's position is the number of tokens above it.
    trees, at = {}, {}
    for r in sorted(tokens, key=lambda r: (r["tree"], r["start"])):
        sequence = trees.setdefault(r["tree"], [])
        assert r["start"] == len(sequence)
        sequence += r["ids"]
        node = tuple(chats[r["branch"]][: r["place"] + 1])
        at[node] = (r["tree"], r["start"], len(r["ids"]))
        assert node[:-1] in nodes or len(node) == 1
        assert coder.decode(r["ids"], skip_special_tokens=False) == formatted(*node[-1])
        assert coder.decode(r["ids"][r["body_from"] : r["body_to"]], skip_special_tokens=False) == chat_tree.escape(node[-1][1])
        assert r["learned"] == (node[-1][0] == "assistant")
    assert set(at) == nodes
    for r in tokens:
        node = tuple(chats[r["branch"]][: r["place"] + 1])
        assert r["position"] == sum(at[node[:i]][2] for i in range(1, len(node)))
    # Depth first: what lies below a node follows it without a gap.
    for node, (tree, start, length) in at.items():
        below = [(s, n) for other, (t, s, n) in at.items() if other[: len(node)] == node]
        assert min(s for s, _ in below) == start and max(s + n for s, n in below) - start == sum(n for _, n in below)
    # Ancestors' intervals, then its own, are a conversation.
    assert {r["conv_id"] for r in branches} == set(chats)
    for r in branches:
        spans = [(a["start"], a["stop"]) for a in r["attends"]]
        if r["length"]:
            assert r["position"] == sum(b - a for a, b in spans)
            spans.append((r["start"], r["start"] + r["length"]))
        ids = [i for a, b in spans for i in trees[r["tree"]][a:b]]
        assert coder.decode(ids, skip_special_tokens=False) == "".join(formatted(*t) for t in chats[r["conv_id"]])
        assert r["turns"] == len(chats[r["conv_id"]])


def test_read_back_and_clashing_columns(spark):
    rows = some_chats(4) + [(None, 0, "user", "no conversation"), (7, None, None, None), (9, 1, "a\nb\\n<|", "role"), (9, 2, "assistant", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("ids", "place", "piece", "owner", "tree", "start", "position", "branch", "h1", "salt", "one", "end")])
    found = {tuple(r) for r in chat_tree.report(df.repartition(5)).collect()}
    chats = plain_turns([r for r in rows if r[1] is not None]) | {7: [("", "")], -1: [("user", MARKS), ("assistant", MARKS)]}
    assert found == plain_report(chats)


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (2, 5, "user", "a"), (2, 5, "user", "b"), (2, 6, "assistant", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    tokens, branches = chat_tree.format_chats(df)
    assert tokens.count() == 4  # equal turns in equal order are one path, whatever their numbers
    assert {r["conv_id"]: (r["turns"], r["length"] > 0) for r in branches.collect()} == {1: (4, True), 2: (3, False)}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [df.collect() for df in chat_tree.format_chats(empty)] == [[], []]
    assert [r["conv_id"] for r in chat_tree.report(empty).collect()] == [-1]


def test_a_first_turn_and_a_text_of_many(spark):
    """One first turn opens all conversations: its node is emitted once, and its readers are dealt out."""
    rows = [(c, t, ("user", "assistant")[t % 2], "same" if t == 0 else f"{c % 40} {t}") for c in range(400) for t in range(3)]
    rows.append((1000, 0, "user", "long " * 40_000))
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    tokens, branches = chat_tree.format_chats(df)
    assert tokens.count() == 1 + 40 * 2 + 1
    assert {tuple(r) for r in chat_tree.read_back(tokens, branches).collect()} == plain_report(plain_turns(rows))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\n\nabim_é", max_size=30))
def test_escapes_are_reversible_and_leave_no_mark(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text
    assert "<|" not in chat_tree.escape(text) and "\n" not in chat_tree.escape_role(text)
