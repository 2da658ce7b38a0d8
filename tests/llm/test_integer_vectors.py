"""Centroid clusters and ball codes against plain searches through all centres."""

import hashlib
import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from deskmetrics.llm import ball_codes, mean_clusters
from deskmetrics.llm.int_vectors import distances, integer_vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def whole(vector):
    return [math.floor(1024 * v) for v in vector]


def plain_nearest(x, centres):
    found = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
    return found.index(min(found)), min(found)


def plain_lloyd(rows, centres, rounds):
    for _ in range(rounds):
        groups = {}
        for x in rows:
            groups.setdefault(plain_nearest(x, centres)[0], []).append(x)
        centres = [[sum(v) // len(groups[c]) for v in zip(*groups[c])] if c in groups else old for c, old in enumerate(centres)]
    return centres


def some_vectors(seed, n=300, length=64, groups=6):
    """Lumps, vectors between them, one vector that is everywhere, ties and components below zero."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.6, (groups, length))
    rows = middle[rng.integers(0, groups, n)] + rng.normal(0, 0.1, (n, length))
    rows[: n // 3] = rows[0]
    rows[-10:] = np.round(rows[-10:])
    return [(3 * i + 1, v.tolist(), None if i % 7 == 0 else int(i % 3)) for i, v in enumerate(rows)]


ODD = [
    (2, None, 1), (4, [], 1), (6, [0.5] * 63 + [None], 1), (8, [0.5] * 63 + [float("nan")], 1), (10, [0.5] * 63 + [float("inf")], None),
    (12, [0.25] * 63, 1), (14, [0.0] * 64, None), (None, [0.1] * 64, 2), (None, [-0.1] * 64, None), (16, [0.3] * 64, 5), (16, [0.3] * 64, 5),
    (16, [0.2] * 64, 5), (18, [2e5] * 64, 0),
]


def kept(rows):
    return [r for r in rows if r[1] and len(r[1]) == 64 and all(v is not None and abs(v) < 131072 for v in r[1])]


def with_clashes(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in ("x", "codes", "errors", "cluster", "distance", "n", "total", "part", "entry", "of_label", "code", "error")])


def by_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def expected_clusters(rows, k=8, rounds=10, seed=3):
    rows = [(i, whole(v)) for i, v, _ in kept(rows)]
    key = lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centres = plain_lloyd([x for _, x in rows], [x for _, x in sorted([r for r in rows if r[0] is not None], key=key)[:k]], rounds)
    found = [(i, *plain_nearest(x, centres)) for i, x in rows]
    inertia = sum(d for *_, d in found)
    by = {c: sum(d for _, e, d in found if e == c) for c in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return by_rows((i, c, d, by[c], inertia, digest[c]) for i, c, d in found)


def expected_codes(rows, parts=4, entries=256, rounds=4):
    rows = [(i, whole(v), g) for i, v, g in kept(rows)]
    width = 64 // parts
    first = sorted([r for r in rows if r[0] is not None], key=lambda r: (r[0], r[1]))[:entries]
    books, found = [], [["", 0] for _ in rows]
    for p in range(parts):
        cut = lambda x: x[p * width : (p + 1) * width]  # noqa: B023, E731
        book = plain_lloyd([cut(x) for _, x, _ in rows], [cut(x) for _, x, _ in first], rounds)
        books += [v for entry in book for v in entry]
        for own, (_, x, _) in zip(found, rows):
            entry, d = plain_nearest(cut(x), book)
            own[0] += f"{entry:02x}"
            own[1] += d
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    total = {g: sum(own[1] for own, r in zip(found, rows) if r[2] == g) for *_, g in rows}
    return by_rows((i, code, d, total[g], digest) for (code, d), (i, _, g) in zip(found, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_match_a_plain_search(spark, seed):
    rows = some_vectors(seed) + (ODD if seed == 2 else [])
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    assert by_rows(mean_clusters.report(df).collect()) == expected_clusters(rows)


def test_codes_match_a_plain_search(spark):
    rows = some_vectors(3, 320) + ODD
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    assert by_rows(ball_codes.report(df).collect()) == expected_codes(rows)


def test_fewer_vectors_than_entries_and_labels_joined_without_broadcast(spark, monkeypatch):
    rows = some_vectors(4, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(ball_codes, "BROADCAST_LABELS", 0)
    assert by_rows(ball_codes.report(df).collect()) == expected_codes(rows)
    assert by_rows(mean_clusters.report(df.limit(5)).collect()) == expected_clusters([tuple(r) for r in df.limit(5).collect()])


def test_no_vectors(spark):
    for rows in ([], [(None, [0.5] * 64, 1)], [(1, None, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert mean_clusters.report(df).collect() == []
        assert ball_codes.report(df).collect() == []


def test_length_that_cannot_be_cut(spark):
    with pytest.raises(ValueError):
        ball_codes.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0)], SCHEMA))


def test_large_components_stay_exact(spark):
    rows = [(i, [(-1) ** j * (130_000.0 - i * 7 - j / 1024) for j in range(64)], 0) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert by_rows(mean_clusters.report(df).collect()) == expected_clusters(rows)
    found = {r["vec_id"]: r["error"] for r in ball_codes.report(df).collect()}
    assert found == {r[0]: r[2] for r in expected_codes(rows)}
    assert integer_vectors(df).first()["x"][0] == whole(rows[0][1])[0]


def test_searches_pass_over_centres_without_changing_the_result():
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (40, 16)) + rng.integers(-4000, 4000, (40, 1))
    x = centres[rng.integers(0, 40, 2000)] + rng.integers(-60, 60, (2000, 16))
    full = distances(x, centres)
    winner, best, computed = mean_clusters.MeanOrder(centres).nearest(x)
    assert (winner == full.argmin(1)).all() and (best == full.min(1)).all()
    assert computed < 0.2 * full.size
    start = rng.integers(0, 40, 2000)
    near = np.where(rng.random(2000) < 0.8, full.argmin(1), start)
    radius = np.array([math.sqrt(full[near == c, c].max(initial=0)) for c in range(40)])
    winner, best, looked = ball_codes.Balls(centres, radius).assign(x, near)
    assert (winner == full.argmin(1)).all() and (best == full.min(1)).all()
    assert looked < 0.5 * full.size
    stable = ball_codes.Balls(centres, np.array([math.sqrt(full[full.argmin(1) == c, c].max(initial=0)) for c in range(40)]))
    assert stable.assign(x, full.argmin(1))[2] < 0.1 * full.size


def test_ties_go_to_the_smaller_number():
    centres = np.array([[5, 5], [-5, -5], [5, -5], [5, 5]])
    x = np.array([[5, 0], [0, 0], [5, 5]])
    assert mean_clusters.MeanOrder(centres).nearest(x)[0].tolist() == [0, 0, 0]
    assert ball_codes.Balls(centres, np.full(4, 99.0)).assign(x, np.array([3, 2, 3]))[0].tolist() == [0, 0, 0]
