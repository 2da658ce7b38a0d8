"""Enrichment joins (J01-J10) and the category baseline.

Each item row (ticket, change, problem) is extended with looked-up names. The category,
weight and request-type tables (and with the categories the per-category baseline) are
broadcast after a bounded size check. The bridge joins fan
out (many rows per item) and go through ``joins.fan_out_join``: a bridge is cut to the report's items at its scan
(``prefilter``), its users' names are looked up, and it meets the items in one join on the item; items that hold a
large share of the bridge (``hotkeys``) go apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import in_dates, observer_eligible
from ..schemas import ROLE_ASSIGNED, ROLE_OBSERVER
from ..sources.tables import Tables
from .hotkeys import Hot, heavy_keys
from .joins import FanOut, fan_out, hot_test, left_lookup, max_broadcast_rows, row_counts
from .prefilter import IdFilter


DIMENSIONS = ("categories", "category_weights", "request_types")


@dataclass
class Lookups:
    """Dimension tables of one source, each with a checked broadcast decision.

    One small job per report counts the category, weight and request-type tables, so a table that
    grows during a long session is seen.
    A table within ``spark.deskmetrics.broadcast.maxRows`` is broadcast; the category
    check also bounds the per-category baseline (one row per known category). A table
    beyond the limit is left to Spark (sort-merge join, or AQE's broadcast if measured small).
    """

    categories: DataFrame
    categories_small: bool
    weights: DataFrame
    weights_small: bool
    request_types: DataFrame
    request_types_small: bool
    #: Rows of the report's windows, counted in the same job, by name.
    rows: dict = field(default_factory=dict)

    @classmethod
    def of(
        cls, tables: Tables, max_rows: int | None = None, windows: dict[str, DataFrame] | None = None, needed: Sequence[str] = DIMENSIONS
    ) -> "Lookups":
        """``needed`` are the tables that the report looks up; the others are not counted (and taken as large)."""
        frames = {name: getattr(tables, name) for name in DIMENSIONS}
        limit = max_broadcast_rows(tables.categories) if max_rows is None else max_rows
        windows = windows or {}
        counted = {name: frames[name] for name in needed} if limit > 0 else {}
        counts = row_counts({**counted, **{f"window {k}": df for k, df in windows.items()}})
        small = {name: name in counted and counts[name] <= limit for name in DIMENSIONS}
        return cls(
            frames["categories"],
            small["categories"],
            frames["category_weights"],
            small["category_weights"],
            frames["request_types"],
            small["request_types"],
            {k: counts[f"window {k}"] for k in windows},
        )


def join_category(df: DataFrame, lk: Lookups, name: str = "nome_categoria") -> DataFrame:
    """J01."""
    return left_lookup(df, lk.categories, "itilcategories_id", "id", {"name": name}, lk.categories_small)


def join_category_weight(df: DataFrame, lk: Lookups) -> DataFrame:
    """J05 (joined on the item id only, so duplicate weights would fan out)."""
    return left_lookup(df, lk.weights, "itilcategories_id", "items_id", {"pesofield": "peso"}, lk.weights_small)


def join_request_type(df: DataFrame, lk: Lookups) -> DataFrame:
    """J04."""
    return left_lookup(df, lk.request_types, "requesttypes_id", "id", {"name": "origem"}, lk.request_types_small)


def bridge_rows(bridge: DataFrame, item_col: str, role: int, keep: IdFilter | None = None) -> DataFrame:
    """Bridge rows of one role as ``(__item, __user)``, cut to the items that ``keep`` may contain."""
    rows = bridge.filter(F.col("type") == role).select(F.col(item_col).alias("__item"), F.col("users_id").alias("__user"))
    return rows if keep is None else keep.cut(rows, F.col("__item"))


def hot_items(tables: Tables, bridge: str, item_col: str, role: int = ROLE_ASSIGNED) -> Hot:
    """A bridge's rows of one role, and the items that hold a large share of them; looked up once for each ``Tables``."""
    return tables.remembered(("hot", bridge, role), lambda: heavy_keys(bridge_rows(getattr(tables, bridge), item_col, role), "__item"))


def staff_names(bridge: DataFrame, users: DataFrame, item_col: str, name: str, role: int = ROLE_ASSIGNED, keep: IdFilter | None = None) -> DataFrame:
    """``(__item, __user, name)``, one row per assigned user; a user that is missing has a null name."""
    return left_lookup(bridge_rows(bridge, item_col, role, keep), users, "__user", "id", {"firstname": name})


def assignees(
    bridge: DataFrame, users: DataFrame, item_col: str, name: str = "nome_tecnico", role: int = ROLE_ASSIGNED, keep: IdFilter | None = None
) -> FanOut:
    """J02 + J03 as a fan-out that adds the assigned user's id (``__user``) and first name."""
    return FanOut(staff_names(bridge, users, item_col, name, role, keep), ["__item"], ["__user", name])


def join_assignee(
    df: DataFrame,
    bridge: DataFrame,
    users: DataFrame,
    item_col: str,
    name: str = "nome_tecnico",
    role: int = ROLE_ASSIGNED,
    keep: IdFilter | None = None,
    hot: Sequence | None = None,
) -> DataFrame:
    """J02 + J03: one row per (item, assigned user); the first name of that user.

    An item without an assignee keeps one row with a null name; a bridge row whose
    user is missing keeps its row with a null name too. ``keep`` must hold every id of ``df``. ``hot`` names the items that hold a large share of
    the bridge; they are looked up if it is None.
    """
    if hot is None:
        hot = heavy_keys(bridge_rows(bridge, item_col, role), "__item").keys
    return fan_out(df, ["id"], [assignees(bridge, users, item_col, name, role, keep)], hot_test(hot)).drop("__user")


def category_days(tickets: DataFrame, first, last) -> DataFrame:
    """Mergeable parts of the category means (A01, A02): per category and opening day in ``first..last``, the sums of the close and solve
    delays and how many there are. Any window inside is a fold of its days (``fold_days``)."""
    return (
        tickets.filter(in_dates("date", first, last))
        .groupBy("itilcategories_id", F.to_date("date").alias("day"))
        .agg(
            *[
                part
                for c in ("close", "solve")
                for part in (F.sum(f"{c}_delay_stat").alias(f"{c}_sum"), F.count(f"{c}_delay_stat").alias(f"{c}_n"))
            ]
        )
    )


def fold_days(days: DataFrame, lk: Lookups, first, last, close_name: str = "tempo_medio_fechamento", solve_name: str = "tempo_medio_solucao") -> DataFrame:
    """A01-A03 (J06/J07 right side): mean close and solve delay per category over the days ``first..last``.

    Categories absent from the category table never match, as in the original, hence the semi join.
    Output: ``(itilcategories_id, close mean, solve mean)``, at most one row per category."""
    mean = lambda c: F.try_divide(F.sum(f"{c}_sum").cast("double"), F.sum(f"{c}_n"))
    per_category = (
        days.filter(in_dates("day", first, last))
        .groupBy("itilcategories_id")
        .agg(mean("close").alias(close_name), mean("solve").alias(solve_name))
    )
    known = lk.categories.select(F.col("id").alias("__cat"))
    if lk.categories_small:
        known = F.broadcast(known)
    return per_category.join(known, per_category["itilcategories_id"] == known["__cat"], "left_semi")


def category_baseline(
    tickets: DataFrame,
    lk: Lookups,
    first,
    last,
    close_name: str = "tempo_medio_fechamento",
    solve_name: str = "tempo_medio_solucao",
    days: DataFrame | None = None,
) -> DataFrame:
    """The category means over ``first..last`` from the tickets, or from ``days`` that cover the window.

    One aggregate for both means (the original computes the same grouping twice). All
    statuses count; only tickets opened within ``first..last`` do."""
    return fold_days(category_days(tickets, first, last) if days is None else days, lk, first, last, close_name, solve_name)


def join_category_baseline(
    df: DataFrame,
    baseline: DataFrame,
    lk: Lookups,
    close_name: str = "tempo_medio_fechamento",
    solve_name: str = "tempo_medio_solucao",
) -> DataFrame:
    """J06 + J07. The baseline has at most one row per known category, so it is as
    small as the category table and is broadcast when that one is."""
    return left_lookup(
        df,
        baseline,
        "itilcategories_id",
        "itilcategories_id",
        {close_name: close_name, solve_name: solve_name},
        lk.categories_small,
    )


def observer_pairs(tickets: DataFrame, tables: Tables, first, last) -> DataFrame:
    """A12 (J08 right side): distinct (ticket, observer first name) for tickets opened in
    ``first..last``, observers limited to eligible users (F08); null names never match."""
    t = tickets.filter(in_dates("date", first, last)).select(F.col("id").alias("__t"))
    observers = tables.tickets_users.filter(F.col("type") == ROLE_OBSERVER).select(
        F.col("tickets_id").alias("__t2"), F.col("users_id").alias("__u")
    )
    eligible = tables.users.filter(observer_eligible()).select(
        F.col("id").alias("__uid"), F.col("firstname").alias("nome_observador")
    )
    pairs = t.join(observers, t["__t"] == observers["__t2"], "inner").join(
        eligible, F.col("__u") == eligible["__uid"], "inner"
    )
    return pairs.select(F.col("__t").alias("id"), "nome_observador").distinct()


def eligible_observers(tables: Tables, keep: IdFilter | None = None) -> DataFrame:
    """Distinct ``(__item, nome_observador)`` over the eligible users (F08) of the bridge's observers."""
    eligible = tables.users.filter(observer_eligible()).select(F.col("id").alias("__uid"), F.col("firstname").alias("nome_observador"))
    rows = bridge_rows(tables.tickets_users, "tickets_id", ROLE_OBSERVER, keep)
    return rows.join(eligible, F.col("__user") == F.col("__uid"), "inner").select("__item", "nome_observador").distinct()


def observers(tables: Tables, first, last, keep: IdFilter | None = None) -> FanOut:
    """J08 as a fan-out: tickets without an eligible observer, or opened outside ``first..last``, keep a null one.

    It follows the assignees, by whom the rows of one ticket differ."""
    return FanOut(eligible_observers(tables, keep), ["__item"], ["nome_observador"], in_dates("date", first, last), "__user")
