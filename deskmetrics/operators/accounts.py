"""Account growth per creation day (R08: F05 F06 J13 A06 A07).

Per day: how many eligible accounts were created (``novas_contas``), and how many eligible
accounts have an id up to the largest id created that day (``total_contas``). The
original gets the second figure from a self-join on ``u1.id >= u2.id``, which pairs every
account with every smaller one (quadratic). Here the days are the pieces of a prefix count:

1. ``day_tops``: the largest id of each day, combined on the map side; there are as many rows as calendar days, so
   the driver may hold them. Sorted, the distinct tops cut the ids into steps;
2. one shuffle of the accounts, on the id: per id its distinct days. An id that repeats is combined on the map side, and the
   number of calendar days bounds what it collects;
3. each id counts once for each of its days, and once for its step (a binary search in the tops), both combined on the map side;
4. a running sum over the steps, as many as there are days, gives each top the number of ids up to it.

No accounts are sorted, ranked, written or gathered in ranges, so no task's rows depend on how dense the ids are or on a setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import active_account


def eligible_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter(active_account() & F.col("id").isNotNull()).select("id", F.to_date("date_creation").alias("data"))


def day_tops(accounts: DataFrame) -> list[int]:
    """The largest eligible id of each creation day, distinct and ascending."""
    per_day = eligible_accounts(accounts).groupBy("data").agg(F.max("id").alias("top"))
    return sorted({r["top"] for r in per_day.collect()})


def step_of(key: Column, tops: Column, n: int) -> Column:
    """How many of the ``n`` ascending ``tops`` are smaller than ``key``, by binary search."""
    width = 1
    while width <= n:
        width *= 2
    halves = []
    while width > 1:
        width //= 2
        halves.append(width)
    start = F.lit(0)
    ahead = lambda at, half: F.coalesce(F.get(tops, at + half - 1) < key, F.lit(False))
    return F.aggregate(F.lit(halves), start, lambda at, half: F.when(ahead(at, half), at + half).otherwise(at))


def as_array(numbers: list[int]) -> Column:
    """One literal (an array column of many literals would be as many calls)."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").try_cast("array<bigint>")


def account_growth(accounts: DataFrame) -> DataFrame:
    tops = day_tops(accounts)
    places = as_array(tops)
    step = lambda key: step_of(F.col(key).cast("bigint"), places, len(tops))
    per_id = eligible_accounts(accounts).groupBy("id").agg(F.collect_set("data").alias("days"))
    # A row with a day counts the id for that day, the one without counts it for its step.
    marks = F.explode(F.concat("days", F.array(F.lit(None).cast("date")))).alias("data")
    marked = per_id.select("id", step("id").alias("step"), marks)
    counts = marked.groupBy("data", F.when(F.col("data").isNull(), F.col("step")).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("top")
    )
    placed = counts.withColumn("step", F.coalesce("step", step("top")))
    up_to = Window.orderBy("step").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # two rows per calendar day at most
    total = F.sum(F.when(F.col("data").isNull(), F.col("n"))).over(up_to)
    grown = placed.select("data", F.col("n").cast("bigint").alias("novas_contas"), total.cast("bigint").alias("total_contas"))
    return grown.filter(F.col("data").isNotNull())
