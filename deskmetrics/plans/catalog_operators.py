"""

Each runs one operator over the whole test tables; the report-level queries are in
``catalog``. Importing this module registers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import expressions as X
from ..functions import predicates as PR
from ..sources.tables import Tables
from . import reports as R
from .catalog import (
    ACCOUNTS_BODY,
    CHANGES_SQL,
    OBSERVED_CTE,
    PROBLEMS_SQL,
    PERIOD,
    TWO_METRICS,
    WORKLOG_CTE,
    register,
    rounded_sql,
)

GRADED_CTES = O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)])

# -- S: scans, parameterised SQL, sinks ----------------------------------------------------


def _scan(name: str):
    @register(f"scan_{name}", O.with_fixtures(f"SELECT * FROM {name}"))
    def scan(t: Tables) -> DataFrame:
        return getattr(t, name)

    scan.__doc__ = f"S01/S03-S12: the whole {name} table."
    return scan


for _name in (
    "tickets",
    "tasks",
    "timers",
    "tickets_users",
    "users",
    "accounts",
    "categories",
    "category_weights",
    "request_types",
    "changes",
    "changes_users",
    "problems",
    "problems_users",
):
    _scan(_name)


@register("param_sql", O.with_fixtures(CHANGES_SQL))
def param_sql(t: Tables) -> DataFrame:
    """The changes report from a SQL text with named parameters."""
    from ..operators.joins import keep_columns
    from ..schemas import CHANGE_TAG, COMMON_COLUMNS
    from .sql import run_sql_report

    df = run_sql_report(t, "changes", PERIOD)
    return keep_columns(df.drop("type").withColumn("type", F.lit(CHANGE_TAG)), COMMON_COLUMNS)


@register(
    "param_sql_tickets",
    O.with_fixtures(
        rounded_sql("SELECT * FROM assigned", ["tempo_medio_fechamento", "tempo_medio_solucao"]), O.ASSIGNED
    ),
)
def param_sql_tickets(t: Tables) -> DataFrame:
    """The assigned-ticket query from a SQL text with named parameters."""
    from .sql import run_sql_report

    return run_sql_report(t, "tickets_assigned", PERIOD)


@register("param_sql_problems", O.with_fixtures(PROBLEMS_SQL))
def param_sql_problems(t: Tables) -> DataFrame:
    """The problems report from a SQL text with named parameters."""
    from ..operators.joins import keep_columns
    from ..schemas import COMMON_COLUMNS, PROBLEM_TAG
    from .sql import run_sql_report

    df = run_sql_report(t, "problems", PERIOD)
    return keep_columns(df.drop("type").withColumn("type", F.lit(PROBLEM_TAG)), COMMON_COLUMNS)


@register("param_sql_tasks", O.with_fixtures("SELECT * FROM tasks"))
def param_sql_tasks(t: Tables) -> DataFrame:
    """The task table from its SQL text (a whole-table scan)."""
    from .sql import run_sql_report

    return run_sql_report(t, "tasks")


@register(
    "param_sql_observed",
    O.with_fixtures(
        rounded_sql("SELECT * FROM observed", ["tempo_medio_fechamento", "tempo_medio_solucao"]), OBSERVED_CTE
    ),
)
def param_sql_observed(t: Tables) -> DataFrame:
    """The observed-ticket query from its SQL text."""
    from .sql import run_sql_report

    return run_sql_report(t, "tickets_observed", PERIOD)


@register("param_sql_worklog", O.with_fixtures("SELECT * FROM wl_grouped", WORKLOG_CTE))
def param_sql_worklog(t: Tables) -> DataFrame:
    """The grouped worklog from its SQL text (sums before the assignee fan-out)."""
    from .sql import run_sql_report

    return run_sql_report(t, "worklog", PERIOD)


@register("param_sql_accounts", O.with_fixtures(ACCOUNTS_BODY))
def param_sql_accounts(t: Tables) -> DataFrame:
    """Account growth from its SQL text (steps of the days' largest ids)."""
    from .sql import run_sql_report

    return run_sql_report(t, "accounts_growth")


def _report_text_sql(body: str) -> str:
    return f"""
SELECT CAST(id AS VARCHAR) AS id, strftime(date, '%d/%m/%Y') AS date, CAST(itilcategories_id AS VARCHAR) AS itilcategories_id,
       CAST(close_delay_stat AS VARCHAR) AS close_delay_stat, CAST(solve_delay_stat AS VARCHAR) AS solve_delay_stat,
       strftime(solvedate, '%d/%m/%Y') AS solvedate, nome_tecnico, nome_categoria, CAST(peso AS VARCHAR) AS peso, type
FROM ({body}) r
"""


@register("sink_report", O.with_fixtures(_report_text_sql(CHANGES_SQL)))
def sink_report(t: Tables) -> DataFrame:
    """The changes report written as a CSV report (dates dd/MM/yyyy) and read back."""
    from ..session import fresh_path
    from ..sources.sinks import read_report, write_report

    path = write_report(R.changes_report(t, PERIOD), fresh_path(t.spark, "report"))
    return read_report(t.spark, path)


@register(
    "sink_snapshot",
    O.with_fixtures(
        rounded_sql(
            "SELECT id, data_tarefa, ultima_modificacao, tecnico_do_chamado, tecnico_das_tarefas, categoria_chamado, "
            "tempo_via_plugin, tempo_via_glpi, tempo_eleito FROM worklog",
            ["tempo_eleito"],
        ),
        WORKLOG_CTE,
    ),
)
def sink_snapshot(t: Tables) -> DataFrame:
    """The worklog stage result written as a parquet snapshot and read back."""
    from ..session import fresh_path
    from ..sources.sinks import write_snapshot

    path = write_snapshot(R.worklog_report(t, PERIOD), fresh_path(t.spark, "snapshot"))
    return t.spark.read.parquet(path)


@register(
    "ticket_snapshot",
    O.with_fixtures(
        rounded_sql(
            f"""SELECT id, CAST(date AS DATE) AS date, status, {O.type_label_sql('type_code')} AS type, itilcategories_id,
       requesttypes_id, {O.clock_sql('close_secs')} AS close_delay_stat, {O.clock_sql('solve_secs')} AS solve_delay_stat,
       CAST(solvedate AS DATE) AS solvedate, CAST(time_to_resolve AS DATE) AS time_to_resolve,
       nome_categoria, peso, origem, nome_tecnico, tempo_medio_fechamento, tempo_medio_solucao,
       tempo_fechamento, tempo_solucao, atraso FROM derived""",
            ["tempo_medio_fechamento", "tempo_medio_solucao", "tempo_fechamento", "tempo_solucao"],
        ),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def ticket_snapshot(t: Tables) -> DataFrame:
    """The ticket rows after the derived columns, before grading."""
    return R.ticket_snapshot(t, PERIOD)


# -- P: report periods over a column of dates ---------------------------------------------


@register(
    "period_baseline",
    O.with_fixtures(
        "SELECT o_orderkey, make_date(year(o_orderdate) - 1, 1, 1) AS first_day, "
        "make_date(year(o_orderdate) - 1, 12, 31) AS last_day FROM orders"
    ),
)
def period_baseline(t: Tables) -> DataFrame:
    """P01 per row, taking each order date as the report's final date."""
    from ..functions import period as P

    o = t.source.raw(t.spark, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", P.baseline_first_col(d).alias("first_day"), P.baseline_last_col(d).alias("last_day"))


@register(
    "period_default",
    O.with_fixtures(
        "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) - 365 AS initial_date, "
        "CAST(date_trunc('month', o_orderdate) AS DATE) AS final_date FROM orders"
    ),
)
def period_default(t: Tables) -> DataFrame:
    """P02 per row, taking each order date as today."""
    from ..functions import period as P

    o = t.source.raw(t.spark, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", P.default_initial_col(d).alias("initial_date"), P.default_final_col(d).alias("final_date")
    )


@register(
    "period_modes",
    O.with_fixtures(
        "SELECT o_orderkey, DATE '2019-01-01' AS geral_initial, last_day(CAST(o_orderdate AS DATE)) AS geral_final, "
        "CAST(date_trunc('month', last_day(CAST(o_orderdate AS DATE)) - 360) AS DATE) AS anual_initial, "
        "last_day(CAST(o_orderdate AS DATE)) AS anual_final FROM orders"
    ),
)
def period_modes(t: Tables) -> DataFrame:
    """P03/P04 per row, taking each order date as today."""
    from ..functions import period as P

    o = t.source.raw(t.spark, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        P.whole_history_initial_col().alias("geral_initial"),
        P.month_end_col(d).alias("geral_final"),
        P.annual_initial_col(d).alias("anual_initial"),
        P.month_end_col(d).alias("anual_final"),
    )


# -- F: predicates over whole tables -------------------------------------------------------



@register(
    "filter_period",
    O.with_fixtures(f"SELECT * FROM tickets WHERE CAST(date AS DATE) BETWEEN {O.INITIAL} AND {O.FINAL}"),
)
def filter_period(t: Tables) -> DataFrame:
    """F01."""
    return t.tickets.filter(PR.in_dates("date", PERIOD.initial, PERIOD.final))


@register(
    "filter_interval_inside",
    O.with_fixtures(
        f"SELECT * FROM timers WHERE CAST(actual_begin AS DATE) BETWEEN {O.INITIAL} AND {O.FINAL} "
        f"AND CAST(actual_end AS DATE) BETWEEN {O.INITIAL} AND {O.FINAL}"
    ),
)
def filter_interval_inside(t: Tables) -> DataFrame:
    """F02."""
    return t.timers.filter(PR.interval_inside("actual_begin", "actual_end", PERIOD.initial, PERIOD.final))


@register("filter_finished", O.with_fixtures("SELECT * FROM tickets WHERE status = 5 OR status = 6"))
def filter_finished(t: Tables) -> DataFrame:
    """F03."""
    return t.tickets.filter(PR.finished("status"))


@register("filter_has_technician", O.with_fixtures("SELECT * FROM tasks WHERE users_id_tech != 0"))
def filter_has_technician(t: Tables) -> DataFrame:
    """F04."""
    return t.tasks.filter(PR.has_technician("users_id_tech"))


@register(
    "filter_active_accounts",
    O.with_fixtures(
        "SELECT * FROM accounts WHERE is_deleted = 0 AND is_active = 1 AND date_creation IS NOT NULL"
    ),
)
def filter_active_accounts(t: Tables) -> DataFrame:
    """F05 + F06."""
    return t.accounts.filter(PR.active_account())


EXCLUDED_NAME = "NATION_7"


@register(
    "filter_exclude_technician",
    O.with_fixtures(
        rounded_sql(
            f"SELECT * FROM assigned WHERE nome_tecnico IS DISTINCT FROM '{EXCLUDED_NAME}'",
            ["tempo_medio_fechamento", "tempo_medio_solucao"],
        ),
        O.ASSIGNED,
    ),
)
def filter_exclude_technician(t: Tables) -> DataFrame:
    """one first name excluded, tickets without a technician kept."""
    return R.assigned_tickets(t, PERIOD).filter(PR.not_excluded("nome_tecnico", [EXCLUDED_NAME]))


@register(
    "filter_observer_users",
    O.with_fixtures(
        "SELECT * FROM users WHERE (groups_id = 1 OR groups_id = 2) AND id <> 6 AND firstname IS NOT NULL"
    ),
)
def filter_observer_users(t: Tables) -> DataFrame:
    """F08."""
    return t.users.filter(PR.observer_eligible())


# -- C/J/A: projections, joins and aggregates ------------------------------------------------


@register(
    "enrich_tickets",
    O.with_fixtures(
        rounded_sql("SELECT * FROM assigned", ["tempo_medio_fechamento", "tempo_medio_solucao"]), O.ASSIGNED
    ),
)
def enrich_tickets(t: Tables) -> DataFrame:
    """C01 + J01-J07: the assigned-ticket query."""
    return R.assigned_tickets(t, PERIOD)


@register(
    "project_detail",
    O.with_fixtures(
        rounded_sql(
            f"""SELECT id, CAST(date AS DATE) AS date, {O.type_label_sql('type_code')} AS type, nome_categoria, peso, origem,
       nome_tecnico, tempo_medio_fechamento, tempo_medio_solucao, tempo_fechamento, tempo_solucao, atraso,
       nota_final_tempos, delta_tempo_solucao, diferenca_media_vs_gasto_solucao, nota_final FROM final""",
            [
                "tempo_medio_fechamento",
                "tempo_medio_solucao",
                "tempo_fechamento",
                "tempo_solucao",
                "nota_final_tempos",
                "delta_tempo_solucao",
                "diferenca_media_vs_gasto_solucao",
                "nota_final",
            ],
        ),
        GRADED_CTES,
    ),
)
def project_detail(t: Tables) -> DataFrame:
    """C03 with the detail allow-list applied to the full graded frame (input order kept,
    names the frame lacks, such as ``locations_id``, ignored)."""
    from ..operators.joins import keep_columns
    from ..schemas import DETAIL_COLUMNS

    return keep_columns(R.graded_tickets_full(t, PERIOD), DETAIL_COLUMNS)


@register(
    "project_common",
    O.with_fixtures(
        f"""SELECT id, CAST(date AS DATE) AS date, {O.type_label_sql('type_code')} AS type, itilcategories_id,
       {O.clock_sql('close_secs')} AS close_delay_stat, {O.clock_sql('solve_secs')} AS solve_delay_stat,
       CAST(solvedate AS DATE) AS solvedate, nome_categoria, peso, nome_tecnico FROM derived""",
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def project_common(t: Tables) -> DataFrame:
    """R03 / C03 with the common allow-list."""
    return R.tickets_for_combining(t, PERIOD)


@register(
    "join_category",
    O.with_fixtures(
        f"SELECT *, {O.looked_up('categories', 'name', 'id', 'itilcategories_id')} AS nome_categoria FROM tickets"
    ),
)
def join_category(t: Tables) -> DataFrame:
    """J01 over all tickets."""
    from ..operators import enrich as E

    return E.join_category(t.tickets, E.Lookups.of(t))


@register(
    "join_assignee",
    O.with_fixtures(
        f"SELECT * EXCLUDE (person), person AS nome_tecnico FROM ({O.with_staff('tickets', 'staff')}) named",
        f"staff AS ({O.staff_sql('tickets_users', 'tickets_id')})",
    ),
)
def join_assignee(t: Tables) -> DataFrame:
    """J02 + J03 over all tickets (fans out per assignee)."""
    from ..operators import enrich as E

    return E.join_assignee(t.tickets, t.tickets_users, t.users, "tickets_id")


@register(
    "join_request_type",
    O.with_fixtures(
        f"SELECT *, {O.looked_up('request_types', 'name', 'id', 'requesttypes_id')} AS origem FROM tickets"
    ),
)
def join_request_type(t: Tables) -> DataFrame:
    """J04 over all tickets."""
    from ..operators import enrich as E

    return E.join_request_type(t.tickets, E.Lookups.of(t))


@register(
    "join_category_weight",
    O.with_fixtures(
        f"SELECT *, {O.looked_up('category_weights', 'pesofield', 'items_id', 'itilcategories_id')} AS peso FROM tickets"
    ),
)
def join_category_weight(t: Tables) -> DataFrame:
    """J05 over all tickets."""
    from ..operators import enrich as E

    return E.join_category_weight(t.tickets, E.Lookups.of(t))


BASELINE_ONLY = O.mean_cte("baseline", O.FIRST_DAY, O.LAST_DAY)


@register(
    "join_category_baseline",
    O.with_fixtures(
        rounded_sql(
            "SELECT t.*, b.avg_close AS tempo_medio_fechamento, b.avg_solve AS tempo_medio_solucao "
            "FROM tickets t LEFT JOIN baseline b ON t.itilcategories_id = b.category",
            ["tempo_medio_fechamento", "tempo_medio_solucao"],
        ),
        BASELINE_ONLY,
    ),
)
def join_category_baseline(t: Tables) -> DataFrame:
    """J06 + J07 over all tickets (previous-year baseline)."""
    from ..operators import enrich as E

    lk = E.Lookups.of(t)
    base = E.category_baseline(t.tickets, lk, PERIOD.baseline_first, PERIOD.baseline_last)
    return E.join_category_baseline(t.tickets, base, lk)


@register(
    "category_baseline",
    O.with_fixtures(
        rounded_sql(
            "SELECT category AS itilcategories_id, avg_close AS tempo_medio_fechamento, avg_solve AS tempo_medio_solucao "
            "FROM baseline",
            ["tempo_medio_fechamento", "tempo_medio_solucao"],
        ),
        BASELINE_ONLY,
    ),
)
def category_baseline(t: Tables) -> DataFrame:
    """A01 + A02: one aggregate for both category means, previous calendar year."""
    from ..operators import enrich as E

    days = E.category_days(t.tickets, PERIOD.baseline_first, PERIOD.final)  # one table for this and the next window
    return E.fold_days(days, E.Lookups.of(t, needed=("categories",)), PERIOD.baseline_first, PERIOD.baseline_last)


@register(
    "category_baseline_to_date",
    O.with_fixtures(
        rounded_sql(
            "SELECT category AS itilcategories_id, avg_close AS tempo_medio_fechamento, avg_solve AS tempo_medio_solucao "
            "FROM obs_baseline",
            ["tempo_medio_fechamento", "tempo_medio_solucao"],
        ),
        OBSERVED_CTE,
    ),
)
def category_baseline_to_date(t: Tables) -> DataFrame:
    """The same means from January 1 of the previous year to the final date."""
    from ..operators import enrich as E

    days = E.category_days(t.tickets, PERIOD.baseline_first, PERIOD.final)
    return E.fold_days(days, E.Lookups.of(t, needed=("categories",)), PERIOD.baseline_first, PERIOD.final)


# -- W: per-month tables ---------------------------------------------------------------------



def _with_deltas(t: Tables):
    from ..operators import scoring as S

    cfg = R.ScoreConfig()
    derived = S.derive_ticket_columns(R.assigned_tickets(t, PERIOD), cfg.exclude_technicians)
    return S, cfg, S.with_deltas(derived, cfg)


@register(
    "month_bounds",
    O.with_fixtures(
        rounded_sql("SELECT DISTINCT date2, max_mes_solucao, min_mes_solucao FROM bounded", ["max_mes_solucao", "min_mes_solucao"]),
        GRADED_CTES,
    ),
)
def month_bounds(t: Tables) -> DataFrame:
    """W01 + W02 as an aggregate (one row per month)."""
    S, cfg, wd = _with_deltas(t)
    return S.month_ranges(S.technician_groups(wd, cfg), cfg).select("date2", "max_mes_solucao", "min_mes_solucao")


@register(
    "technician_volume",
    O.with_fixtures(
        "SELECT DISTINCT date2, nome_tecnico, qtde_chamados, vol_min AS min_qtde_chamados, vol_max AS max_qtde_chamados "
        "FROM normed WHERE nome_tecnico IS NOT NULL",
        GRADED_CTES,
    ),
)
def technician_volume(t: Tables) -> DataFrame:
    """W03 + W04: rows per (month, technician) with the month's smallest and largest volume."""
    S, cfg, wd = _with_deltas(t)
    groups = S.technician_groups(wd, cfg)
    months = S.month_ranges(groups, cfg).select("date2", "min_qtde_chamados", "max_qtde_chamados")
    named = groups.where("nome_tecnico IS NOT NULL").select("date2", "nome_tecnico", "qtde_chamados")
    return named.join(months, "date2", "left")


# -- X: scalar expressions over whole tables -----------------------------------------------


@register(
    "delay_days",
    O.with_fixtures(
        rounded_sql(
            "SELECT id, close_delay_stat / 86400.0 AS tempo_fechamento, solve_delay_stat / 86400.0 AS tempo_solucao FROM tickets",
            ["tempo_fechamento", "tempo_solucao"],
        )
    ),
)
def delay_days(t: Tables) -> DataFrame:
    """X01."""
    return t.tickets.select(
        "id", X.seconds_to_days("close_delay_stat").alias("tempo_fechamento"), X.seconds_to_days("solve_delay_stat").alias("tempo_solucao")
    )


@register(
    "delay_hms",
    O.with_fixtures(
        f"SELECT id, {O.clock_sql('close_delay_stat')} AS close_delay_stat, "
        f"{O.clock_sql('solve_delay_stat')} AS solve_delay_stat FROM tickets"
    ),
)
def delay_hms(t: Tables) -> DataFrame:
    """X02."""
    return t.tickets.select(
        "id",
        X.seconds_to_clock("close_delay_stat").alias("close_delay_stat"),
        X.seconds_to_clock("solve_delay_stat").alias("solve_delay_stat"),
    )


@register("type_label", O.with_fixtures(f"SELECT id, {O.type_label_sql('type')} AS type FROM tickets"))
def type_label(t: Tables) -> DataFrame:
    """X03."""
    return t.tickets.select("id", X.type_label("type").alias("type"))


@register("late_flag", O.with_fixtures("SELECT id, coalesce(solvedate > time_to_resolve, false) AS atraso FROM tickets"))
def late_flag(t: Tables) -> DataFrame:
    """X04."""
    return t.tickets.select("id", X.late_flag("solvedate", "time_to_resolve").alias("atraso"))


@register("month_key", O.with_fixtures("SELECT id, strftime(date, '%Y-%m') AS date2 FROM tickets"))
def month_key(t: Tables) -> DataFrame:
    """X05 + X07."""
    return t.tickets.select("id", X.month_key("date").alias("date2"))


@register(
    "truncate_timestamps",
    O.with_fixtures(
        "SELECT id, CAST(date AS DATE) AS date, status, type, itilcategories_id, requesttypes_id, close_delay_stat, "
        "solve_delay_stat, CAST(solvedate AS DATE) AS solvedate, CAST(time_to_resolve AS DATE) AS time_to_resolve FROM tickets"
    ),
)
def truncate_timestamps(t: Tables) -> DataFrame:
    """X06."""
    return X.truncate_timestamps(t.tickets)


CLIPPED_BODY = """
SELECT t.id,
       CASE WHEN b.avg_close / 86400.0 - t.close_delay_stat / 86400.0 IS NULL THEN NULL
            ELSE least(greatest(b.avg_close / 86400.0 - t.close_delay_stat / 86400.0, CAST(-1.0 AS DOUBLE)), CAST(0.4 AS DOUBLE)) END
         AS delta_tempo_fechamento,
       CASE WHEN b.avg_solve / 86400.0 - t.solve_delay_stat / 86400.0 IS NULL THEN NULL
            ELSE least(greatest(b.avg_solve / 86400.0 - t.solve_delay_stat / 86400.0, CAST(-1.0 AS DOUBLE)), CAST(0.4 AS DOUBLE)) END
         AS delta_tempo_solucao
FROM tickets t LEFT JOIN baseline b ON t.itilcategories_id = b.category
"""


def _deltas_all_tickets(t: Tables) -> DataFrame:
    from ..operators import enrich as E

    lk = E.Lookups.of(t)
    base = E.category_baseline(t.tickets, lk, PERIOD.baseline_first, PERIOD.baseline_last)
    df = E.join_category_baseline(t.tickets, base, lk)
    cols = {}
    for m, secs in (("fechamento", "close_delay_stat"), ("solucao", "solve_delay_stat")):
        mean = X.seconds_to_days(f"tempo_medio_{m}")
        cols[f"delta_tempo_{m}"] = X.clip(mean - X.seconds_to_days(secs), -1.0, 0.4)
        cols[f"diferenca_media_vs_gasto_{m}"] = X.safe_ratio(cols[f"delta_tempo_{m}"], mean)
    return df.select("id", *[c.alias(n) for n, c in cols.items()])


@register(
    "clipped_delta",
    O.with_fixtures(rounded_sql(CLIPPED_BODY, ["delta_tempo_fechamento", "delta_tempo_solucao"]), BASELINE_ONLY),
)
def clipped_delta(t: Tables) -> DataFrame:
    """X08 + X09 over all tickets (previous-year baseline)."""
    return _deltas_all_tickets(t).select("id", "delta_tempo_fechamento", "delta_tempo_solucao")


@register(
    "relative_deviation",
    O.with_fixtures(
        rounded_sql(
            "SELECT id, delta_tempo_fechamento / nullif(b.avg_close / 86400.0, 0) AS diferenca_media_vs_gasto_fechamento, "
            "delta_tempo_solucao / nullif(b.avg_solve / 86400.0, 0) AS diferenca_media_vs_gasto_solucao "
            f"FROM ({CLIPPED_BODY}) d JOIN tickets t2 USING (id) LEFT JOIN baseline b ON t2.itilcategories_id = b.category",
            ["diferenca_media_vs_gasto_fechamento", "diferenca_media_vs_gasto_solucao"],
        ),
        BASELINE_ONLY,
    ),
)
def relative_deviation(t: Tables) -> DataFrame:
    """X11 over all tickets."""
    return _deltas_all_tickets(t).select("id", "diferenca_media_vs_gasto_fechamento", "diferenca_media_vs_gasto_solucao")


@register(
    "month_grade",
    O.with_fixtures(
        rounded_sql(
            "SELECT id, nome_tecnico, date2, delta_tempo_solucao_normalized FROM final",
            ["delta_tempo_solucao_normalized"],
        ),
        GRADED_CTES,
    ),
)
def month_grade(t: Tables) -> DataFrame:
    """Min-max grade within the month."""
    return R.graded_tickets_full(t, PERIOD).select("id", "nome_tecnico", "date2", "delta_tempo_solucao_normalized")


TWO_CTES = O.ASSIGNED + ",\n" + O.derived_cte([("fechamento", 2), ("solucao", 1)])


@register(
    "weighted_grade",
    O.with_fixtures(
        rounded_sql("SELECT id, nome_tecnico, nota_final_tempos FROM final", ["nota_final_tempos"]), TWO_CTES
    ),
)
def weighted_grade(t: Tables) -> DataFrame:
    """X12 with weights {fechamento: 2, solucao: 1}."""
    return R.graded_tickets_full(t, PERIOD, TWO_METRICS).select("id", "nome_tecnico", "nota_final_tempos")


@register(
    "volume_bonus",
    O.with_fixtures(
        rounded_sql("SELECT id, nome_tecnico, qtde_chamados, bonus FROM final", ["bonus"]), GRADED_CTES
    ),
)
def volume_bonus(t: Tables) -> DataFrame:
    """Volume bonus per detail row."""
    return R.graded_tickets_full(t, PERIOD).select("id", "nome_tecnico", "qtde_chamados", "bonus")
