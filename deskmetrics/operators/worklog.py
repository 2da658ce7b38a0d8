"""Worklog: time spent per ticket, task technician and day (R04) and its month summary.

The original query joins tickets, tasks, timers, the assignee bridge and users, and only
then groups by (ticket, task technician, end day). Every assignee of a ticket repeats
each timer row, so sums are multiplied by the assignee count. The same result is built
here with the fan-out moved after the aggregation:

1. timers inside the window (pushed to the scan) join their task (technician set);
2. that is pre-aggregated per (ticket, technician, end day): the big shuffle carries one
   row per group instead of one per timer x assignee;
3. assignees are reduced to one row per ticket (row count, smallest first name), and the
   sums are multiplied by that count, which is what the fan-out does to a sum.

A hot ticket or technician is therefore combined on the map side before any shuffle.
The groups are written once, and the assignee summary and the tickets only cover tickets that have work
in the window (``prefilter``), not the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.predicates import has_technician, interval_inside, not_excluded
from ..schemas import ROLE_ASSIGNED, WORKLOG_SUMMARY_LABELS
from ..sources.tables import Tables
from ..session import materialize
from .enrich import Lookups, bridge_rows, hot_items
from .hotkeys import heavy_keys
from .joins import left_lookup, lookup_with_hot_keys
from .prefilter import id_filter


def worklog_grouped(tables: Tables, initial, final) -> DataFrame:
    """R04 SQL part (F02 F04 J01-J03 J11 J12 A04 A05 X18): one row per
    (ticket, task technician, end day), with the loose columns taken as ``min``."""
    timers = tables.timers.filter(interval_inside("actual_begin", "actual_end", initial, final)).select(
        F.col("tasks_id"),
        F.to_date("actual_end").alias("ultima_modificacao"),
        F.col("actual_actiontime"),
    )
    tasks = tables.tasks.filter(has_technician("users_id_tech")).select(
        F.col("id").alias("__task"),
        F.col("tickets_id"),
        F.to_date("date").alias("data_tarefa"),
        F.col("users_id_tech"),
        F.col("actiontime"),
    )
    work = timers.join(tasks, timers["tasks_id"] == tasks["__task"], "inner")
    grouped = work.groupBy("tickets_id", "users_id_tech", "ultima_modificacao").agg(
        F.min("data_tarefa").alias("data_tarefa"),
        F.sum("actual_actiontime").alias("__plugin"),
        F.sum("actiontime").alias("__glpi"),
    )

    # The groups are far fewer than the timers and are read twice below: written once.
    grouped = materialize(grouped)
    ids = grouped.select("tickets_id")
    hot = heavy_keys(grouped, "tickets_id")
    lk = Lookups.of(tables, needed=("categories",))
    # Everything a ticket adds, one row per ticket with work in the window: its category (any status; a task's ticket must
    # exist), its number of assignee rows and their smallest first name. Both histories are cut to those tickets at the scan.
    keep = id_filter(ids, hot.rows, hot_items(tables, "tickets_users", "tickets_id").rows)
    tickets = tables.tickets.select("id", "itilcategories_id")
    tickets = tickets if keep is None else keep.cut(tickets, F.col("id"))
    bridge = bridge_rows(tables.tickets_users, "tickets_id", ROLE_ASSIGNED, keep)
    tickets = left_lookup(tickets, lk.categories, "itilcategories_id", "id", {"name": "categoria_chamado"}, lk.categories_small)
    people = (
        left_lookup(bridge, tables.users, "__user", "id", {"firstname": "firstname"})
        .groupBy("__item")
        .agg(F.count(F.lit(1)).alias("__n_assignees"), F.min("firstname").alias("tecnico_do_chamado"))
    )
    per_ticket = tickets.join(people, tickets["id"] == people["__item"], "left")
    # One join on the ticket, whose other side has one row per ticket; a hot ticket's groups stay where they are.
    g = lookup_with_hot_keys(grouped, per_ticket, "tickets_id", "id", hot.keys)
    g = left_lookup(g, tables.users, "users_id_tech", "id", {"firstname": "tecnico_das_tarefas"})
    fan_out = F.coalesce(F.col("__n_assignees"), F.lit(1))
    return g.select(
        F.col("tickets_id").alias("id"),
        "data_tarefa",
        "ultima_modificacao",
        "tecnico_do_chamado",
        "tecnico_das_tarefas",
        "categoria_chamado",
        (F.col("__plugin") * fan_out).alias("tempo_via_plugin"),
        (F.col("__glpi") * fan_out).alias("tempo_via_glpi"),
    )


def elect_time(df: DataFrame, drop_outliers: bool = True, exclude: Sequence[str] = ()) -> DataFrame:
    """R04 pandas part (X15 X16 X01 F07): reset outliers, pick timer or manual time, days."""
    if drop_outliers:
        df = df.withColumns(
            {
                "tempo_via_plugin": X.reset_outlier("tempo_via_plugin"),
                "tempo_via_glpi": X.reset_outlier("tempo_via_glpi"),
            }
        )
    secs = X.elected_time("tempo_via_plugin", "tempo_via_glpi")
    # The exact integer seconds stay (hidden) for the summary's sums.
    df = df.withColumns({"tempo_eleito": X.seconds_to_days(secs), "__eleito_secs": secs})
    if exclude:
        df = df.filter(not_excluded("tecnico_das_tarefas", exclude))
    return df


def worklog_summary(detail: DataFrame, labels: bool = True) -> DataFrame:
    """R05 (X07 A11 C04): per task technician and month of the end day, distinct
    tickets, total time (0 when every value is null) and mean time over detail rows.

    Sums and means are taken over the exact integer seconds when the detail still has
    them (``__eleito_secs``), then turned into days."""
    if "__eleito_secs" in detail.columns:
        total = F.sum("__eleito_secs") / F.lit(X.SECONDS_PER_DAY)
        mean = F.avg("__eleito_secs") / F.lit(X.SECONDS_PER_DAY)
    else:
        total, mean = F.sum("tempo_eleito"), F.avg("tempo_eleito")
    out = (
        detail.withColumn("data_mes", X.month_key("ultima_modificacao"))
        .filter(F.col("tecnico_das_tarefas").isNotNull() & F.col("data_mes").isNotNull())
        .groupBy("tecnico_das_tarefas", "data_mes")
        .agg(
            F.count_distinct("id").alias("id"),
            F.coalesce(total, F.lit(0.0)).alias("tempo_eleito"),
            mean.alias("tempo_eleito2"),
        )
    )
    if labels:
        out = out.withColumnsRenamed(WORKLOG_SUMMARY_LABELS)
    return out
