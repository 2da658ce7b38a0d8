"""Centroid clustering by equal-average equal-variance search.

Vectors are whole numbers (``int_vectors``), so every step is exact. With S the sum of a vector's d components and V the length
of what is left after its mean is taken off, any two vectors x and c have

    distance^2  >=  (S_x - S_c)^2 / d  +  (V_x - V_c)^2.

* Centroids are sorted by their mean. A vector starts at its own mean and goes outward, always to the side whose next centroid is nearer in mean.
* Mean inequality: once the first term alone exceeds the best distance, no centroid further out can win, and the search ends.
* Deviation inequality: a centroid whose two terms together exceed the best distance is passed over.
* What is left gets its exact integer distance. The inequalities are evaluated in doubles with a margin to the safe side,
  so they never decide between near equal distances; ties go to the smaller number.

Each round is one pass over the written integer vectors: tasks add up their vectors by cluster, Spark adds the tasks' sums, and
k x d sums reach the driver. No vector moves. Nothing depends on how many vectors one cluster has.

Defined results: vectors that are null, hold null or non-finite components, have another length than ``length`` or a component of
131072 or more (its squares fit no long) take no part. A row with a null id is clustered, but never a starting centroid. Rows that
repeat an id are vectors of their own; among equal ids the smaller vector starts. With fewer vectors than ``k`` there are as many
centroids as vectors with an id; without any, the result is empty. A cluster's or all vectors' sum that fits no long is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmetrics.llm.common import written
from deskmetrics.llm.int_vectors import gathered, group_sums, integer_vectors, lists, long_or_null, matrix, sums_of

K = 8
LENGTH = 64
ROUNDS = 10
SEED = 3

ASSIGNED = "vec_id bigint, cluster int, distance bigint"
CLUSTERS = "cluster int, members bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>, centroid_sha256 string"


class MeanOrder:
    """Centroids in order of their mean, with what the two inequalities need."""

    def __init__(self, centroids: np.ndarray):
        self.number = np.argsort(centroids.sum(1), kind="stable")
        self.rows = centroids[self.number]
        self.sums = self.rows.sum(1)
        self.spread = deviations(self.rows, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid's number and exact squared distance of each row, and how many distances were computed."""
        n, d = x.shape
        k = len(self.rows)
        sums = x.sum(1)
        spread = deviations(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        winner = np.full(n, k)
        alive, computed = np.arange(n), 0
        while len(alive):
            low, high = left[alive], right[alive]
            down = np.where(low >= 0, sums[alive] - self.sums[np.maximum(low, 0)], np.inf)
            up = np.where(high < k, self.sums[np.minimum(high, k - 1)] - sums[alive], np.inf)
            go_down = down <= up
            by_mean = np.minimum(down, up) ** 2 / d
            limit = best[alive] * (1 + 1e-9) + 1e-3
            going = by_mean <= limit
            alive, go_down, by_mean, limit = alive[going], go_down[going], by_mean[going], limit[going]
            candidate = np.where(go_down, left[alive], right[alive])
            left[alive] -= go_down
            right[alive] += ~go_down
            close = by_mean + (spread[alive] - self.spread[candidate]) ** 2 <= limit
            rows, candidate = alive[close], candidate[close]
            gap = x[rows] - self.rows[candidate]
            distance = np.einsum("ij,ij->i", gap, gap)
            computed += len(rows)
            number = self.number[candidate]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < winner[rows]))
            best[rows[better]], winner[rows[better]] = distance[better], number[better]
        return winner, best, computed


def deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return np.linalg.norm(x - (sums / x.shape[1])[:, None], axis=1)


def starting(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose '<seed>:<vec_id>' has the smallest sha256, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    first = rows.where(F.col("vec_id").isNotNull()).orderBy(F.sha2(text, 256), "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def one_round(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty centroid replaced by the componentwise floor of its vectors' mean."""
    k, length = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, counts, total = MeanOrder(centroids), np.zeros(k, np.int64), np.zeros((k, length), np.int64)
        for some in gathered(batches, 8_192):
            x = matrix(some.column("x"))
            n, sums = group_sums(x, order.nearest(x)[0], k)
            counts += n
            total += sums
        full = np.flatnonzero(counts)
        columns = [pa.array(full.astype(np.int32)), pa.array(counts[full]), lists(total[full], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    found = rows.select("x").mapInArrow(add, "cluster int, n bigint, total array<bigint>")
    out = centroids.copy()
    for r in found.groupBy("cluster").agg(F.sum("n").alias("n"), *sums_of("total", length)).collect():
        out[r["cluster"]] = [int(r[f"t{i}"]) // r["n"] for i in range(length)]
    return out


def cluster(vectors: DataFrame, k: int = K, length: int = LENGTH, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance) of every vector, and one row for each cluster with members (at most ``k``)."""
    spark = vectors.sparkSession
    own = integer_vectors(vectors)
    rows = written(own.where(F.size("x") == length), "clustered")
    centroids = starting(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), spark.createDataFrame([], CLUSTERS)
    for _ in range(rounds):
        centroids = one_round(rows, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        for some in gathered(batches, 8_192):
            number, distance, _ = order.nearest(matrix(some.column("x")))
            ids = some.column("vec_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = written(rows.mapInArrow(assign, ASSIGNED), "clusters")
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = long_or_null(sum(int(r["d"]) for r in sums))
    found = []
    for r in sums:
        centre = centroids[r["cluster"]].tolist()
        digest = hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()
        found.append((r["cluster"], r["n"], long_or_null(int(r["d"])), inertia, centre, digest))
    return assigned, spark.createDataFrame(found, CLUSTERS)


def report(vectors: DataFrame) -> DataFrame:
    """One row per vector, with its cluster's figures (a table of at most ``K`` rows is broadcast)."""
    assigned, clusters = cluster(vectors)
    out = assigned.join(F.broadcast(clusters), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _report_sql(k: int = K, length: int = LENGTH, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same in SQL, every vector against every centroid in each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
cells AS MATERIALIZED (SELECT r, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM kept),
starts AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x FROM kept
  WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k}),
centre0 AS MATERIALIZED (SELECT c, generate_subscripts(x, 1) AS i, unnest(x) AS w FROM starts)"""
    ]
    for t in range(rounds + 1):
        steps.append(f"""near{t} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT r, c, sum((v - w) * (v - w)) AS d FROM cells JOIN centre{t} USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            steps.append(f"""mean{t} AS (
  SELECT c, i, sum(v) AS s, count(*) AS n FROM near{t} JOIN cells USING (r) GROUP BY c, i),
centre{t + 1} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN w ELSE (s - ((s % n) + n) % n) // n END AS w
  FROM centre{t} LEFT JOIN mean{t} USING (c, i))""")
    steps.append(f"""named AS (
  SELECT c, sha256(string_agg(CAST(CAST(w AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS digest FROM centre{rounds} GROUP BY c)""")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS "cluster", CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN named USING (c)"""
    )


REPORT_SQL = _report_sql()
