"""Jaccard groups, nearest neighbours and personal data against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from edge_tables import corpus, edge_docs, no_docs  # noqa: F401
from deskmetrics.llm import jaccard, pii, projected_nn


def shingle_set(text):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def plain_groups(rows):
    """{doc_id: (n_shingles, component)} by an inverted index over all shingles."""
    sets, parent, index = {i: shingle_set(t) for i, t in rows}, {i: i for i, _ in rows}, {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in sets.items():
        met = Counter(j for g in s for j in index.get(g, ()))
        for j, k in met.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in s:
            index.setdefault(g, []).append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def grouped(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_groups(df).collect()}


def odd_corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(30):
        n = rng.choice([0, 1, 3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 50, 80, 200, 600])
        base = [rng.choice(words) for _ in range(n)]
        for _ in range(rng.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, int(n * 0.03)])):
                if own:
                    k, way = rng.randrange(len(own)), rng.random()
                    own[k : k + 1] = [rng.choice(words)] if way < 0.4 else [] if way < 0.7 else [own[k], rng.choice(words)]
            texts.append(" ".join(own))
    # A passage that many documents share, and a chain whose ends do not link.
    passage = " ".join(rng.choice(words) for _ in range(60))
    some = lambda: " ".join(rng.choice(words) for _ in range(60))
    texts += [f"{some()} {passage} {some()}" for _ in range(80)]
    chain = [rng.choice(words) for _ in range(120)]
    for k in range(12):
        chain[k * 9 % 120] = rng.choice(words)
        texts.append(" ".join(chain))
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(100_000, None), (100_001, " \n\t")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [5, 6])
def test_groups_match_brute_force(spark, seed):
    rows = odd_corpus(seed)
    assert grouped(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain_groups(rows)


def test_groups_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert grouped(docs) == plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_group_edge_cases(spark, edge_docs, no_docs):
    rows = jaccard.link_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    own = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert own[0]["n_shingles"] == own[1]["n_shingles"] == own[2]["n_shingles"] == 0 and own[2]["component_id"] == 2
    assert own[5]["component_id"] == 4 and all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert jaccard.link_groups(no_docs).count() == 0
    kept = jaccard.keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11]


def test_sketch_distance_bounds_the_difference():
    """Blocks that differ are no more than shingles that differ, so linked sets share ``need`` codes."""
    rng = np.random.default_rng(3)
    layouts = jaccard.Layouts()
    for _ in range(60):
        n = int(rng.integers(5, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, n // 8)))
        b = np.unique(np.append(a[drop:], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 12)))).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or len(a) == len(b) == both:
            continue
        owner, layout, need, of, _, key = jaccard.block_codes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), layouts)
        shared = 0
        for x in np.flatnonzero(owner == 0):
            for y in np.flatnonzero((owner == 1) & (layout == layout[x])):
                common = len(np.intersect1d(key[of == x], key[of == y]))
                shared = max(shared, common >= max(need[x], need[y]))
        assert shared


def brute_neighbours(ids, x, k=10):
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def found_neighbours(df, **how):
    out = {}
    for r in projected_nn.nearest(df, **how).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_neighbours_of_the_table(spark):
    vectors = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = vectors.collect()
    want = brute_neighbours(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float))
    got = found_neighbours(vectors)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_neighbours_in_several_cells_with_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(projected_nn, "CELL_ROWS", 200)
    monkeypatch.setattr(projected_nn, "LARGEST_CELL", 150)
    monkeypatch.setattr(projected_nn, "BLOCK", 4)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 12)).astype(np.float32).astype(float)
    x[::3] = x[0]  # a third of all rows
    ids = np.arange(1500)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<float>")
    got, want = found_neighbours(df), brute_neighbours(ids, x)
    assert got.keys() == want.keys()
    for q in want:
        if q % 3 == 0:  # equal vectors: ties go to the smaller ids, exactly
            assert got[q] == want[q]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def several_cells(monkeypatch, **sizes):
    for name, value in {"CELL_ROWS": 64, "LARGEST_CELL": 50, "QUERIES": 30, "WIDEN": 4, "TILE": 8, "GROUP": 16, **sizes}.items():
        monkeypatch.setattr(projected_nn, name, value)


def test_neighbours_move_no_vectors_for_the_queries(spark, monkeypatch):
    """What is written between the stages holds each vector once and a query's once more, not a vector for each query and cell."""
    several_cells(monkeypatch)
    held, written = [], projected_nn.written

    def counted(df, name):
        df = written(df, name)
        held.append(df.count() if "x" in df.columns else 0)
        return df

    monkeypatch.setattr(projected_nn, "written", counted)
    x = np.random.default_rng(11).normal(size=(2000, 24))
    x /= np.sqrt((x**2).sum(1))[:, None]  # no cell can be left out
    df = spark.createDataFrame([(10 * i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got, want = found_neighbours(df), brute_neighbours(10 * np.arange(2000), x)
    assert sum(held) <= 2000 + 200
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_neighbours_beyond_cells_with_too_few_vectors(spark, monkeypatch):
    """Fewer than k in most cells, ties, copies and components too large for single precision: what is found is that of a full search."""
    several_cells(monkeypatch, CELL_ROWS=8)
    rng = np.random.default_rng(12)
    x = np.repeat(rng.integers(-3, 4, size=(130, 6)), 3, axis=0) * 1e60 + 0.0
    x[(x == 0).all(1)] = 1e60
    ids = rng.permutation(len(x)) * 5
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>")
    assert found_neighbours(df, confidence=1 - 1e-9) == brute_neighbours(ids, x)


def test_verified_vectors_are_those_within_the_bound():
    rng = np.random.default_rng(13)
    for offset, size in ((0.0, 1.0), (50.0, 0.1), (0.0, 1e30)):
        x, queries = (offset + size * rng.normal(size=(n, 16)) for n in (600, 40))
        x[100:400] = x[100]
        ids, along = rng.permutation(600), projected_nn.directions(16)
        d = np.sqrt(((queries[:, None] - x) ** 2).sum(2))
        bound = np.where(np.arange(40) % 3 == 0, np.inf, np.quantile(d, 0.05))
        asked = np.arange(0, 40, 2)
        row, own, distance = projected_nn.visit(
            x, ids, projected_nn.project(x, along), queries, projected_nn.project(queries, along), np.arange(1000, 1040), asked, bound.copy(), 10, 1e9
        )
        want = [(q, ids[j], d[q, j]) for q in asked for j in [j for j in np.lexsort((ids, d[q])) if d[q, j] <= bound[q]][:10]]
        assert list(zip(row, own, distance, strict=True)) == want


def test_neighbour_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (100, [1.0, 0.0]), (200, []), (8, [3.0, 0.0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<float>, cell string, rank int")
    got = found_neighbours(df)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [100, 1, 8], 100: [0, 1, 8]}
    assert got[0][0][1] == 0.0 and abs(got[0][2][1] - 2.0) < 1e-12
    assert projected_nn.nearest(df.limit(0)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out[kind].append(m.span())
    return out


def test_base_spans_match_the_patterns(corpus):
    rng = random.Random(1)
    parts = ["a", "B", "@", ".", "1", "23", "4", " ", "-", "+", "(", ")", "255", "256", "é", "a@b.c", "1.2.3.4", "4387513035237269", "+1 (968) 555-9369", "%", "_"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 18)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)
    for text in corpus[1].values():
        assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a@" * 80_000, "1." * 100_000, "+1 " + "-" * 100_000, "a" * 200_000 + "@", "1 " * 100_000, "(1)" * 60_000])
def test_long_odd_texts_take_linear_time(text):
    import time

    began = time.process_time()
    pii.base_spans(text)
    pii.candidates(text)
    assert time.process_time() - began < 20


def test_candidates_beside_other_numbers_are_added(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    judge = pii.fit(docs)
    text = "von Hand +1 (269) 555-3296 4524132264652876 und weiter. No. 123456789 on 2024-05-17 costs 12,345.67"
    base, spans = pii.spans_of(text, judge)
    assert base == []
    assert {text[a:b] for _, a, b in spans} == {"+1 (269) 555-3296", "4524132264652876"}
    clean = "Version 3.0 of 1999, see page 12 (chapter 4) and token = \"0641917ea4e9feb9cda83477b57ac2654884f485\""
    assert pii.spans_of(clean, judge) == ([], [])


def test_pii_report_and_redaction(spark, edge_docs, no_docs):
    import hashlib

    rows = {r["doc_id"]: r for r in pii.report(edge_docs).collect() if r["doc_id"] is not None}
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] is not None}
    for i, text in texts.items():
        base = plain_spans(text or "")
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
        assert rows[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(rows[i]["spans"].split(","))
    assert pii.report(no_docs).count() == 0
    out = pii.redacted(edge_docs)
    assert out.columns == edge_docs.columns
    changed = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert "a@b.co" not in changed[11]["text"] and "1.2.3.4" not in changed[11]["text"] and changed[11]["n_chars"] == len(changed[11]["text"])
    assert all(changed[i]["text"] == t for i, t in texts.items() if not any(plain_spans(t or "").values()))


def test_redaction_of_overlapping_spans():
    assert pii.redact("x 12345 y", [(2, 2, 5), (3, 4, 7)]) == "x [CARD] y"
    assert pii.redact("ab", []) == "ab"


def test_a_copy_without_id_does_not_hide_the_others(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words)), (7, " ".join(words)), (9, " ".join([*words[:-1], "other"]))]
    got = grouped(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))
    assert got[7][1] == got[9][1] == 7


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (6, text("b")), (8, text("c")), (8, text("d")), (8, text("d")), (8, "")]
    kept = jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, text("a")), (5, text("b")), (8, text("c")), (8, text("d")), (8, "")])


def test_no_added_span_meets_any_earlier_one():
    """Against a look at every span, however many shorter ones stand between."""
    rng = random.Random(3)
    for _ in range(200):
        spans = [(a, a + rng.choice([1, 2, 3, 40])) for a in (rng.randrange(200) for _ in range(rng.randrange(30)))]
        known = pii.Intervals(spans)
        for _ in range(60):
            a = rng.randrange(210)
            b = a + rng.randrange(1, 12)
            meets = any(s < b and a < e for s, e in spans)
            assert known.meet(a, b) == meets
            if not meets:
                known.add(a, b)
                spans.append((a, b))


def test_an_address_that_holds_many_numbers_keeps_its_span():
    class Sure:
        def score(self, x):
            return np.ones(len(x))

    text = ".".join(["1.2.3.4"] * 12) + "._415-555-0134_x@b.co"
    judge = pii.Judge(Sure(), {k: 0.5 for k in range(4)})
    base, spans = pii.spans_of(text, judge)
    assert (0, 0, len(text)) in base
    assert spans == base


def test_parts_of_the_code_space_follow_the_bytes(spark, monkeypatch):
    """Ten times the documents in ten times the parts: the largest group's bytes stay level, whatever the shuffle partitions."""
    monkeypatch.setattr(jaccard, "PART_BYTES", 3_000)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([40, 80, 120]))) for _ in range(3000)]
    largest = {}
    for n in (300, 3000):
        df = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id bigint, text string").repartition(2)
        parts = jaccard.parts_for(df)
        sent = df.mapInArrow(jaccard._sketch_rows(parts), "part bigint, payload binary")
        sizes = sent.where("part >= 0").groupBy("part").agg(F.sum(F.octet_length("payload")).alias("bytes"))  # the rows of documents go by slices
        largest[n] = sizes.agg(F.max("bytes")).first()[0]
    assert largest[3000] < 2 * largest[300]
    assert jaccard.parts_for(df.limit(0)) == 4


def test_only_nodes_outside_the_commonest_component_are_compared(spark):
    """One node of another label in a group of 5 000: it meets each node once, and the others do not meet each other."""
    rows = [(1, i, 7 if i else 8, 10, "x") for i in range(5000)] + [(2, i, i % 3, 10, "x") for i in range(2500)] + [(3, i, 4, 10, "x") for i in range(9)]
    named = spark.createDataFrame(rows, "gid bigint, node bigint, label bigint, n int, bits string")
    met = jaccard._meetings(named.join(jaccard._open_groups(named), "gid")).collect()
    assert sum(r["gid"] == 1 for r in met) == 5 + 5000
    places = {}
    for r in met:
        places.setdefault((r["gid"], r["i"], r["j"]), ([], []))[0 if r["minor"] else 1].append((r["node"], r["label"]))
    assert max(len(a) for a, _ in places.values()) < 1200 and max(len(b) for _, b in places.values()) < 1200
    pairs = {(g, frozenset((x, y))) for (g, _, _), (a, b) in places.items() for x, lx in a for y, ly in b if g == 2 and lx != ly}
    assert len(pairs) == sum(x % 3 != y % 3 for x in range(2500) for y in range(x))
    assert not any(g == 3 for g, _, _ in places)
