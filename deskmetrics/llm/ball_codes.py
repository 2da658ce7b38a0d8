"""Vector code compression: product codes whose codebooks are fitted by ball k-means.

Vectors are whole numbers (``int_vectors``), cut into equal consecutive parts; each part position has a codebook of its own. The
parts of one entry are its ball. From the second assignment on, a part starts from the entry it had:

* Neighbours: a task is given each ball's radius (the largest distance of its parts, plus how far the entry has moved since). Only
  entries within twice the radius can take a part away from the ball; the others are not looked at.
* Stable core: a part whose distance to its entry is less than half the distance from that entry to its nearest neighbour keeps it.
* Annular rings: neighbours are sorted by their distance from the entry. A part at distance r needs the neighbours within 2 r only; rings of
  ``RING`` neighbours are worked through from the inside, each with the parts that reach so far out.

All three follow from the triangle inequality, decided on exact squared integers (the radius is rounded up), so the codes are those of
a search through all entries; ties go to the lower index. The first assignment has no balls yet and looks at all entries.

Each assignment is one pass that writes vectors and codes to the shared folder (the next one starts from its codes, so a lost
executor repeats one pass only); sums by (part, entry) are added up in tasks, then by Spark, and parts x entries sums reach the driver.

Defined results: vectors that are null, empty, hold null or non-finite components or a component of 131072 or more (its squares fit no long), or have
another length than most (of equally common ones the smaller counts), take no part; the length must be a multiple of ``parts``, or
the call fails. A row with a null id is coded, but never starts an entry. Rows that repeat an id are vectors of their own; among equal ids the
smaller vector comes first. With fewer vectors than entries there are as many entries; without any, the result is empty. A
sum over a label that fits no long is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm.common import written
from deskmetrics.llm.int_vectors import distances, gathered, group_sums, integer_vectors, lists, matrix, sums_of

PARTS = 4
ENTRIES = 256
ROUNDS = 4
RING = 64
#: Labels are joined by broadcast up to this many, counted first; beyond, by a shuffle that AQE may split.
BROADCAST_LABELS = 100_000


class Balls:
    """One codebook with, for each entry, its neighbours by distance, as far as the ball's radius lets them matter."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray):
        self.entries = entries
        apart = distances(entries, entries)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        order = np.argsort(apart, axis=1, kind="stable")
        self.near, self.gap = [], []
        for i, row in enumerate(order):
            gap = apart[i, row]
            last = int(np.searchsorted(gap[:-1], 4 * float(radius[i]) ** 2, side="right"))
            self.near.append(row[:last])
            self.gap.append(gap[:last])

    def assign(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry and squared distance of each row, from the entry it had; and how many other entries were looked at."""
        step = x - self.entries[start]
        best = np.einsum("ij,ij->i", step, step)
        winner = start.copy()
        looked = 0
        order = np.argsort(start, kind="stable")
        bounds = np.searchsorted(start[order], np.arange(len(self.entries) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            ball = order[bounds[i] : bounds[i + 1]]
            reach = np.searchsorted(self.gap[i], 4 * best[ball], side="right")
            out = np.argsort(-reach, kind="stable")  # the stable core, reach 0, comes last
            ball, reach = ball[out], reach[out]
            for inner in range(0, int(reach[0]), RING):
                rows = ball[: np.searchsorted(-reach, -inner, side="left")]
                ring = np.sort(self.near[i][inner : inner + RING])
                found = distances(x[rows], self.entries[ring])
                looked += found.size
                at = found.argmin(1)
                least, entry = found[np.arange(len(rows)), at], ring[at]
                better = (least < best[rows]) | ((least == best[rows]) & (entry < winner[rows]))
                best[rows[better]], winner[rows[better]] = least[better], entry[better]
        return winner, best, looked


def first_assignment(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    winner, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for begin in range(0, len(x), 8_192):
        found = distances(x[begin : begin + 8_192], entries)
        winner[begin : begin + 8_192] = found.argmin(1)
        best[begin : begin + 8_192] = found.min(1)
    return winner, best


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(parts, rows, width)."""
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2)


def assign_all(rows: DataFrame, books: np.ndarray, radius: np.ndarray | None) -> DataFrame:
    """The rows with codes and squared distances by part; ``radius`` is None for the first assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(book, r) for book, r in zip(books, radius)] if radius is not None else None
        for some in gathered(batches):
            x = cut(matrix(some.column("x")), len(books))
            if balls:
                before = matrix(some.column("codes"))
                found = [ball.assign(x[p], before[:, p])[:2] for p, ball in enumerate(balls)]
            else:
                found = [first_assignment(x[p], book) for p, book in enumerate(books)]
            codes, errors = (np.stack([f[j] for f in found], axis=1) for j in (0, 1))
            keep = [some.column(c).combine_chunks() for c in ("vec_id", "x", "label")]
            yield pa.RecordBatch.from_arrays([*keep, lists(codes, pa.int32()), lists(errors, pa.int64())], ["vec_id", "x", "label", "codes", "errors"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id bigint, x array<int>, label {label}, codes array<int>, errors array<bigint>")


def updated(coded: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries' new places, and the balls' radii around them (rounded up)."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        furthest = np.zeros((parts, entries), np.int64)
        for some in gathered(batches):
            x, codes, errors = cut(matrix(some.column("x")), parts), matrix(some.column("codes")), matrix(some.column("errors"))
            for p in range(parts):
                n, sums = group_sums(x[p], codes[:, p], entries)
                counts[p] += n
                total[p] += sums
                np.maximum.at(furthest[p], codes[:, p], errors[:, p])
        part, entry = np.nonzero(counts)
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(furthest[part, entry])]
        yield pa.RecordBatch.from_arrays([*columns, lists(total[part, entry], pa.int64())], ["part", "entry", "n", "furthest", "total"])

    found = coded.select("x", "codes", "errors").mapInArrow(add, "part int, entry int, n bigint, furthest bigint, total array<bigint>")
    out, radius = books.copy(), np.zeros((parts, entries))
    sums = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.max("furthest").alias("furthest"), *sums_of("total", width))
    for r in sums.collect():
        p, e = r["part"], r["entry"]
        out[p, e] = [int(r[f"t{i}"]) // r["n"] for i in range(width)]
        moved = math.sqrt(sum(int(v) ** 2 for v in out[p, e] - books[p, e]))
        radius[p, e] = (math.sqrt(r["furthest"]) + moved) * (1 + 1e-9) + 1e-6
    return out, radius


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes array<int>, errors array<bigint>) of every vector, and the codebooks (parts, entries, width)."""
    spark = vectors.sparkSession
    own = integer_vectors(vectors.withColumn("label", F.col(label)) if label != "label" else vectors, "label")
    sizes = own.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(1).collect()
    empty = spark.createDataFrame([], own.select("vec_id", "label").schema).selectExpr(
        "*", "CAST(NULL AS array<int>) AS codes", "CAST(NULL AS array<bigint>) AS errors"
    )
    if not sizes:
        return empty, np.zeros((parts, 0, 0), np.int64)
    length = sizes[0]["length"]
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = written(own.where(F.size("x") == length), "vectors")
    first = rows.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "x").limit(entries).collect()
    if not first:
        return empty, np.zeros((parts, 0, length // parts), np.int64)
    books = cut(np.array([r["x"] for r in first], np.int64), parts)
    coded = written(assign_all(rows, books, None), "coded")
    for _ in range(rounds):
        books, radius = updated(coded, books)
        coded = written(assign_all(coded, books, radius), "coded")
    return coded.drop("x"), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (vec_id, label, code, error) with the error summed over equal labels, nulls together."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    sums = written(coded.groupBy(F.col("label").alias("of_label")).agg(total.alias("label_error")), "labels")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


def report(vectors: DataFrame) -> DataFrame:
    """One row per vector: its code in hex, its error, its label's error and the codebooks' digest."""
    coded, books = compress(vectors)
    numbers = ",".join(map(str, books.ravel().tolist()))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("bigint")), 2, "0"))), "")
    error = F.aggregate("errors", F.lit(0).cast("bigint"), lambda a, e: a + e)
    out = label_errors(coded.select("vec_id", "label", code.alias("code"), error.alias("error")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))


def _report_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL, every part against every entry in each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
cells AS MATERIALIZED (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS i, v
  FROM (SELECT r, generate_subscripts(x, 1) AS i, unnest(x) AS v, len(x) // {parts} AS w FROM kept)),
starts AS (
  SELECT r, row_number() OVER (ORDER BY vec_id, x) - 1 AS e FROM kept WHERE vec_id IS NOT NULL ORDER BY e LIMIT {entries}),
book0 AS MATERIALIZED (SELECT p, e, i, v AS w FROM starts JOIN cells USING (r))"""
    ]
    for t in range(rounds + 1):
        steps.append(f"""near{t} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, p, e, sum((v - w) * (v - w)) AS d FROM cells JOIN book{t} USING (p, i) GROUP BY r, p, e)
  GROUP BY r, p)""")
        if t < rounds:
            steps.append(f"""mean{t} AS (
  SELECT p, e, i, sum(v) AS s, count(*) AS n FROM near{t} JOIN cells USING (r, p) GROUP BY p, e, i),
book{t + 1} AS MATERIALIZED (
  SELECT p, e, i, CASE WHEN n IS NULL THEN w ELSE (s - ((s % n) + n) % n) // n END AS w
  FROM book{t} LEFT JOIN mean{t} USING (p, e, i))""")
    steps.append(f"""named AS (
  SELECT sha256(string_agg(CAST(CAST(w AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS digest FROM book{rounds}),
coded AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)""")
    return (
        "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN kept USING (r), named"""
    )


REPORT_SQL = _report_sql()
