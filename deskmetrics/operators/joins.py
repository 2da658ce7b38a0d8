"""Join helpers with an explicit size check before any broadcast.

A side is broadcast only when its size is proven: either counted at run time (partial
counts per task, one number each to the final count), or bounded by
construction (e.g. one row per month of a known period). Otherwise no hint is given and
Spark chooses: its static size estimate against ``autoBroadcastJoinThreshold`` and,
with AQE, the measured size of a finished shuffle stage, falling back to a sort-merge
join (with skew-split of hot keys) beyond that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest row count a lookup table may have to be broadcast to every task; the session
# setting ``spark.deskmetrics.broadcast.maxRows`` overrides it (0 turns explicit broadcasts off).
MAX_BROADCAST_ROWS = 100_000
MAX_ROWS_CONF = "spark.deskmetrics.broadcast.maxRows"


def max_broadcast_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(MAX_ROWS_CONF, None)
    return MAX_BROADCAST_ROWS if value in (None, "") else int(value)


def row_counts(dfs: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each frame, all in one small job.

    Every task counts its own rows (for whole parquet files from their footers) and sends one
    number, so no rows travel however large a frame turns out to be."""
    probe = None
    for name, df in dfs.items():
        part = df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        probe = part if probe is None else probe.unionByName(part)
    counts = {r["name"]: r["n"] for r in probe.collect()} if dfs else {}
    return {name: counts.get(name, 0) for name in dfs}


def bounded_counts(dfs: dict[str, DataFrame], max_rows: int) -> dict[str, bool]:
    """For each frame, whether it has at most ``max_rows`` rows."""
    return {name: n <= max_rows for name, n in row_counts(dfs).items()}


def broadcast_by_bound(df: DataFrame, row_bound: int | None, max_rows: int | None = None) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction (``row_bound``)."""
    max_rows = max_broadcast_rows(df) if max_rows is None else max_rows
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df


def left_lookup(
    df: DataFrame,
    lookup: DataFrame,
    left_key: str,
    right_key: str,
    columns: dict[str, str],
    broadcast: bool = False,
) -> DataFrame:
    """``df LEFT JOIN lookup ON df.left_key = lookup.right_key``, adding ``columns``.

    ``columns`` maps lookup column -> output name. Columns of ``df`` keep their order; the
    new ones are appended in the given order. ``broadcast`` only for a checked-small side.
    """
    key_alias = f"__key_{right_key}"
    right = lookup.select(
        F.col(right_key).alias(key_alias), *[F.col(src).alias(dst) for src, dst in columns.items()]
    )
    if broadcast:
        right = F.broadcast(right)
    joined = df.join(right, df[left_key] == right[key_alias], "left")
    return joined.select(*[df[c] for c in df.columns], *[right[c] for c in columns.values()])


def hot_test(hot: Sequence) -> Callable | None:
    """The test whether a one-column key is one of ``hot``; None without any."""
    return (lambda key: key.isin(*hot)) if hot else None


@dataclass(frozen=True)
class FanOut:
    """One right side of ``fan_out``: its key columns, and what it adds.

    ``where`` is a condition on the left rows without which they have no match (a left outer join's ON). ``spread`` names a column of the
    left rows by which those of one hot key differ; without it the right side is the one with many rows per key."""

    right: DataFrame
    keys: Sequence[str]
    columns: Sequence[str]
    where: Column | None = None
    spread: str | None = None


def fan_out(df: DataFrame, keys: Sequence[str], steps: Sequence[FanOut], hot: Callable | None = None) -> DataFrame:
    """``df LEFT JOIN step LEFT JOIN step ...``, all on the same ``keys`` of ``df``; every step may hold many rows per key.

    Rows of ordinary keys are left joins: each side is shuffled once on the keys, and a further step finds the rows where they are.
    A left outer join cannot be split on its right side, and a join whose partitioning the next one uses cannot be split at all. So
    the rows of hot keys (``hot`` tests key columns; see ``hotkeys.heavy_keys``) go apart, with salted keys (``_hot_parts``).
    Rows with a null key have no match.
    """
    named = [FanOut(*_renamed(step, i), step.where, step.spread) for i, step in enumerate(steps)]
    is_hot = lambda cols: F.coalesce(hot(*[F.col(c) for c in cols]), F.lit(False))
    rest = df if hot is None else df.filter(~is_hot(keys))
    for step in named:
        right = step.right if hot is None else step.right.filter(~is_hot(step.keys))
        rest = _left_join(rest, keys, FanOut(right, step.keys, step.columns, step.where))
    if hot is None:
        return rest
    apart = df.filter(is_hot(keys))
    for step in named:
        apart = _hot_parts(apart, keys, FanOut(step.right.filter(is_hot(step.keys)), step.keys, step.columns, step.where, step.spread))
    return rest.unionByName(apart)


def _renamed(step: FanOut, i: int) -> tuple[DataFrame, list[str], list[str]]:
    """The right side under key names of its own."""
    names = [f"__fk{i}_{k}" for k in step.keys]
    return step.right.select(*[F.col(k).alias(n) for k, n in zip(step.keys, names)], *step.columns), names, list(step.columns)


def _on(df: DataFrame, keys: Sequence[str], right: DataFrame, right_keys: Sequence[str], where: Column | None = None):
    on = F.lit(True) if where is None else where
    for k, r in zip(keys, right_keys):
        on = on & (df[k] == right[r])
    return on


def _left_join(df: DataFrame, keys: Sequence[str], step: FanOut) -> DataFrame:
    joined = df.join(step.right, _on(df, keys, step.right, step.keys, step.where), "left")
    return joined.select(*[df[c] for c in df.columns], *[step.right[c] for c in step.columns])


#: Tasks that the rows of one hot key are dealt out to.
SALTS = 32


def _hot_parts(df: DataFrame, keys: Sequence[str], step: FanOut) -> DataFrame:
    """The left join for hot keys only. The side with many rows per key gets a salt, the other one a copy for each salt.

    Keys without a match are found against the distinct hot keys of the right side: at most ``hotkeys.TOP`` a key column, broadcast."""
    own = df if step.where is None else df.filter(step.where)
    salt = lambda *by: F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int").alias("__salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    left = own.select("*", salt(step.spread) if step.spread else every)
    right = step.right.select("*", every if step.spread else salt(*step.columns))
    matched = left.join(right, _on(left, [*keys, "__salt"], right, [*step.keys, "__salt"]), "inner")
    matched = matched.select(*[left[c] for c in df.columns], *[right[c] for c in step.columns])
    known = F.broadcast(step.right.select(*step.keys).distinct())
    missing = df.join(known, _on(df, keys, known, step.keys, step.where), "left_anti")
    nulls = [F.lit(None).cast(step.right.schema[c].dataType).alias(c) for c in step.columns]
    return matched.unionByName(missing.select("*", *nulls))


def lookup_with_hot_keys(df: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Sequence) -> DataFrame:
    """``df JOIN right`` where ``right`` has one row per key and is itself the result of a join on that key, so that AQE cannot split
    this one: the rows of ``right`` for the ``hot`` keys of ``df`` (at most ``hotkeys.TOP``) are broadcast."""
    join = lambda a, b: a.join(b, a[left_key] == b[right_key], "inner")
    if not hot:
        return join(df, right)
    test = hot_test(hot)
    rest = join(df.filter(~F.coalesce(test(df[left_key]), F.lit(False))), right.filter(~test(right[right_key])))
    return rest.unionByName(join(df.filter(test(df[left_key])), F.broadcast(right.filter(test(right[right_key])))))


def keep_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Keep the allowed columns in input order; names not present are ignored."""
    wanted = set(allowed)
    return df.select(*[c for c in df.columns if c in wanted])
