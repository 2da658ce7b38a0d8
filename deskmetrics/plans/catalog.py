"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole test tables, with the report parameters of FIXTURES.md §3. ``ORACLES`` holds the
DuckDB text of every key. This module registers the report-level queries;
``catalog_operators`` (imported at the end) the single-operator ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..functions.period import Period
from ..sources.tables import Tables
from . import reports as R

PERIOD = Period.of("1996-01-01", "2000-06-30")
TWO_METRICS = R.ScoreConfig(weights={"fechamento": 2, "solucao": 1})

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for the cross-engine comparison.

    ``floor(x * 10^d + 0.5) / 10^d`` is the same IEEE arithmetic in Spark and DuckDB, so
    equal inputs give equal outputs even on decimal ties (where the engines' own
    ``round`` functions disagree).
    """
    scale = float(10**digits)
    cols = [
        (F.floor(F.col(f"`{f.name}`") * scale + 0.5) / scale).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def rounded_sql(body: str, double_cols: list[str], digits: int = 6) -> str:
    """Wrap a SELECT so the listed double columns are rounded like ``round_doubles``."""
    if not double_cols:
        return body
    scale = f"{float(10**digits)}::DOUBLE"
    repl = ", ".join(f'floor("{c}" * {scale} + 0.5::DOUBLE) / {scale} AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) q"


_TABLES: dict[tuple[int, str], tuple[SparkSession, Tables]] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """Table handles (lazy plans, no data) shared by the queries of one session."""
    key = (id(spark), sf_dir)
    hit = _TABLES.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, Tables.fixtures(spark, sf_dir))
        _TABLES[key] = hit
    return hit[1]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(tables_for(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# -- R02 technician-month summary (flagship) ------------------------------------------

SUMMARY_BODY = """
SELECT nome_tecnico AS "Técnico", date2 AS "Data",
       count(DISTINCT id) AS "Total de chamados",
       CAST(count(DISTINCT CASE WHEN atraso THEN id END) AS BIGINT) AS "Total de atrasos",
       avg(solve_secs) / 86400.0 AS "Tempo de solução médio",
       round_even(avg(diferenca_media_vs_gasto_solucao), 4) AS "Diferença de tempo percentual em relação a média anual",
       avg(nota_final) AS "Nota final"
FROM final
WHERE nome_tecnico IS NOT NULL AND date2 IS NOT NULL
GROUP BY nome_tecnico, date2
"""


@register(
    "technician_month_summary",
    O.with_fixtures(
        rounded_sql(
            SUMMARY_BODY,
            [
                "Tempo de solução médio",
                "Diferença de tempo percentual em relação a média anual",
                "Nota final",
            ],
        ),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def technician_month_summary(t: Tables) -> DataFrame:
    """R02 with weights {solucao: 1}."""
    return R.technician_month_summary(t, PERIOD)


@register(
    "summary_in_key_order",
    O.with_fixtures(
        rounded_sql(
            f"""SELECT "Técnico", "Data", "Total de chamados", "Nota final", row_number() OVER (ORDER BY "Técnico", "Data") AS posicao
FROM ({SUMMARY_BODY}) s""",
            ["Nota final"],
        ),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def summary_in_key_order(t: Tables) -> DataFrame:
    """The summary's rows with their place in (technician, month) order."""
    return R.with_position(R.technician_month_summary(t, PERIOD).select("Técnico", "Data", "Total de chamados", "Nota final"))


# -- R01 graded ticket detail ----------------------------------------------------------

DETAIL_DOUBLES = [
    "tempo_medio_fechamento",
    "tempo_medio_solucao",
    "tempo_fechamento",
    "tempo_solucao",
    "nota_final_tempos",
    "delta_tempo_solucao",
    "diferenca_media_vs_gasto_solucao",
    "nota_final",
]
DETAIL_BODY = f"""
SELECT id, CAST(date AS DATE) AS date, {O.type_label_sql('type_code')} AS type, nome_categoria, peso, origem,
       nome_tecnico, tempo_medio_fechamento, tempo_medio_solucao, tempo_fechamento, tempo_solucao, atraso,
       nota_final_tempos, delta_tempo_solucao, diferenca_media_vs_gasto_solucao, nota_final
FROM final
"""


@register(
    "graded_tickets",
    O.with_fixtures(rounded_sql(DETAIL_BODY, DETAIL_DOUBLES), O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)])),
)
def graded_tickets(t: Tables) -> DataFrame:
    """R01, clean detail (allow-list), weights {solucao: 1}."""
    return R.graded_tickets(t, PERIOD)


def _full_body(metrics: list[str]) -> str:
    per_metric = []
    for i, m in enumerate(metrics):
        per_metric.append(f"delta_tempo_{m}")
        if i == 0:
            per_metric.append("date2")
        per_metric += [
            f"max_mes_{m}",
            f"min_mes_{m}",
            f"delta_tempo_{m}_normalized",
            f"diferenca_media_vs_gasto_{m}",
        ]
    return f"""
SELECT id, CAST(date AS DATE) AS date, status, {O.type_label_sql('type_code')} AS type, itilcategories_id,
       requesttypes_id, {O.clock_sql('close_secs')} AS close_delay_stat, {O.clock_sql('solve_secs')} AS solve_delay_stat,
       CAST(solvedate AS DATE) AS solvedate, CAST(time_to_resolve AS DATE) AS time_to_resolve,
       nome_categoria, peso, origem, nome_tecnico, tempo_medio_fechamento, tempo_medio_solucao,
       tempo_fechamento, tempo_solucao, atraso, nota_final_tempos, {', '.join(per_metric)},
       qtde_chamados, bonus, nota_final
FROM final
"""


def _full_doubles(metrics: list[str]) -> list[str]:
    out = ["tempo_medio_fechamento", "tempo_medio_solucao", "tempo_fechamento", "tempo_solucao", "nota_final_tempos"]
    for m in metrics:
        out += [f"delta_tempo_{m}", f"max_mes_{m}", f"min_mes_{m}", f"delta_tempo_{m}_normalized", f"diferenca_media_vs_gasto_{m}"]
    return out + ["bonus", "nota_final"]


@register(
    "graded_tickets_full",
    O.with_fixtures(
        rounded_sql(_full_body(["solucao"]), _full_doubles(["solucao"])),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def graded_tickets_full(t: Tables) -> DataFrame:
    """R01 keeping every column (relatorio_limpo=False), weights {solucao: 1}."""
    return R.graded_tickets_full(t, PERIOD)


@register(
    "graded_tickets_two_metrics",
    O.with_fixtures(
        rounded_sql(_full_body(["fechamento", "solucao"]), _full_doubles(["fechamento", "solucao"])),
        O.ASSIGNED + ",\n" + O.derived_cte([("fechamento", 2), ("solucao", 1)]),
    ),
)
def graded_tickets_two_metrics(t: Tables) -> DataFrame:
    """Graded detail with weights {fechamento: 2, solucao: 1}."""
    return R.graded_tickets_full(t, PERIOD, TWO_METRICS)


SUMMARY_TWO_BODY = """
SELECT nome_tecnico AS "Técnico", date2 AS "Data",
       count(DISTINCT id) AS "Total de chamados",
       CAST(count(DISTINCT CASE WHEN atraso THEN id END) AS BIGINT) AS "Total de atrasos",
       avg(close_secs) / 86400.0 AS tempo_fechamento,
       avg(diferenca_media_vs_gasto_fechamento) AS diferenca_media_vs_gasto_fechamento,
       avg(solve_secs) / 86400.0 AS "Tempo de solução médio",
       round_even(avg(diferenca_media_vs_gasto_solucao), 4) AS "Diferença de tempo percentual em relação a média anual",
       avg(nota_final) AS "Nota final"
FROM final
WHERE nome_tecnico IS NOT NULL AND date2 IS NOT NULL
GROUP BY nome_tecnico, date2
"""


@register(
    "summary_two_metrics",
    O.with_fixtures(
        rounded_sql(
            SUMMARY_TWO_BODY,
            [
                "tempo_fechamento",
                "diferenca_media_vs_gasto_fechamento",
                "Tempo de solução médio",
                "Diferença de tempo percentual em relação a média anual",
                "Nota final",
            ],
        ),
        O.ASSIGNED + ",\n" + O.derived_cte([("fechamento", 2), ("solucao", 1)]),
    ),
)
def summary_two_metrics(t: Tables) -> DataFrame:
    """R02 with weights {fechamento: 2, solucao: 1}: close columns included."""
    return R.technician_month_summary(t, PERIOD, TWO_METRICS)


# -- R04/R05 worklog -------------------------------------------------------------------

def worklog_cte(initial=O.INITIAL, final=O.FINAL, suffix="") -> str:
    inside = " AND ".join(f"timers.{c} >= {initial} AND timers.{c} < {final} + INTERVAL 1 DAY" for c in ("actual_begin", "actual_end"))
    return f"""
wl_staff{suffix} AS ({O.staff_sql("tickets_users", "tickets_id")}),
wl_people{suffix} AS (SELECT item, count(*) AS n, min(person) AS person FROM wl_staff{suffix} GROUP BY item),
wl_rows{suffix} AS (
  SELECT tasks.tickets_id AS id, users_id_tech, CAST(actual_end AS DATE) AS ultima_modificacao,
         CAST(tasks.date AS DATE) AS day, actual_actiontime AS timed, actiontime AS noted
  FROM tasks, timers
  WHERE timers.tasks_id = tasks.id AND users_id_tech <> 0 AND {inside}
    AND tasks.tickets_id IN (SELECT id FROM tickets)
),
wl_grouped{suffix} AS (
  SELECT g.id, data_tarefa, ultima_modificacao, person AS tecnico_do_chamado,
         {O.looked_up("users", "firstname", "id", "users_id_tech")} AS tecnico_das_tarefas,
         {O.looked_up("categories", "name", "id", "(SELECT max(itilcategories_id) FROM tickets k WHERE k.id = g.id)")} AS categoria_chamado,
         CAST(timed * coalesce(n, 1) AS BIGINT) AS tempo_via_plugin,
         CAST(noted * coalesce(n, 1) AS BIGINT) AS tempo_via_glpi
  FROM (SELECT id, users_id_tech, ultima_modificacao, min(day) AS data_tarefa, sum(timed) AS timed, sum(noted) AS noted
        FROM wl_rows{suffix} GROUP BY ALL) g
  LEFT JOIN wl_people{suffix} ON item = g.id
),
wl_reset{suffix} AS (
  SELECT id, data_tarefa, ultima_modificacao, tecnico_do_chamado, tecnico_das_tarefas, categoria_chamado,
         CASE WHEN tempo_via_plugin > 1000000000 THEN 0 ELSE tempo_via_plugin END AS tempo_via_plugin,
         CASE WHEN tempo_via_glpi > 1000000000 THEN 0 ELSE tempo_via_glpi END AS tempo_via_glpi
  FROM wl_grouped{suffix}
),
worklog{suffix} AS (
  SELECT *, coalesce(nullif(tempo_via_plugin, 0), tempo_via_glpi) AS eleito_secs,
         coalesce(nullif(tempo_via_plugin, 0), tempo_via_glpi) / 86400.0 AS tempo_eleito
  FROM wl_reset{suffix}
)"""


WORKLOG_CTE = worklog_cte()


@register(
    "worklog_elected",
    O.with_fixtures(
        rounded_sql(
            "SELECT id, data_tarefa, ultima_modificacao, tecnico_do_chamado, tecnico_das_tarefas, categoria_chamado, "
            "tempo_via_plugin, tempo_via_glpi, tempo_eleito FROM worklog",
            ["tempo_eleito"],
        ),
        WORKLOG_CTE,
    ),
)
def worklog_elected(t: Tables) -> DataFrame:
    """Worklog detail with outliers reset and elected time."""
    return R.worklog_report(t, PERIOD)


@register(
    "worklog_detail",
    O.with_fixtures("SELECT * FROM wl_grouped", WORKLOG_CTE),
)
def worklog_detail(t: Tables) -> DataFrame:
    """R04 SQL part (A04 A05 J11 J12 F02 F04): grouped worklog before the pandas steps."""
    from ..operators.worklog import worklog_grouped

    return worklog_grouped(t, PERIOD.initial, PERIOD.final)


@register(
    "worklog_month_summary",
    O.with_fixtures(
        rounded_sql(
            """SELECT tecnico_das_tarefas AS "Técnico", strftime(ultima_modificacao, '%Y-%m') AS "Data",
                      count(DISTINCT id) AS "Número de chamados",
                      coalesce(CAST(sum(eleito_secs) AS BIGINT) / 86400.0, 0.0) AS "Total tempo trabalhado GLPI",
                      avg(eleito_secs) / 86400.0 AS "Média tempo trabalhado GLPI (por chamado)"
               FROM worklog WHERE tecnico_das_tarefas IS NOT NULL
               GROUP BY 1, 2""",
            ["Total tempo trabalhado GLPI", "Média tempo trabalhado GLPI (por chamado)"],
        ),
        WORKLOG_CTE,
    ),
)
def worklog_month_summary(t: Tables) -> DataFrame:
    """R05."""
    return R.worklog_month_summary(t, PERIOD)


# -- R08 account growth ----------------------------------------------------------------

ACCOUNTS_BODY = """
SELECT data, novas_contas, (SELECT count(DISTINCT id) FROM accounts
                            WHERE id <= top AND is_active = 1 AND is_deleted = 0 AND date_creation IS NOT NULL) AS total_contas
FROM (SELECT CAST(date_creation AS DATE) AS data, count(DISTINCT id) AS novas_contas, max(id) AS top
      FROM accounts WHERE is_active = 1 AND is_deleted = 0 AND date_creation IS NOT NULL GROUP BY data) AS days
"""


@register("account_growth", O.with_fixtures(ACCOUNTS_BODY))
def account_growth(t: Tables) -> DataFrame:
    """R08 by steps (checked against a count of all smaller ids per day)."""
    return R.account_growth_report(t)


# -- R06/R07/R09 changes, problems, combined ------------------------------------------


def _change_sql(table: str, bridge: str, key: str, tag: str) -> str:
    return f"""
SELECT id, date, itilcategories_id, close_delay_stat, solve_delay_stat, solvedate, person AS nome_tecnico,
       {O.looked_up("categories", "name", "id", "itilcategories_id")} AS nome_categoria,
       {O.looked_up("category_weights", "pesofield", "items_id", "itilcategories_id")} AS peso, '{tag}' AS type
FROM (
  WITH staff AS ({O.staff_sql(bridge, key)}),
       items AS (SELECT * FROM {table} WHERE status IN (5, 6) AND date >= {O.INITIAL} AND date < {O.FINAL} + INTERVAL 1 DAY)
  {O.with_staff("items", "staff")}
) named
"""


CHANGES_SQL = _change_sql("changes", "changes_users", "changes_id", "Mudança")
PROBLEMS_SQL = _change_sql("problems", "problems_users", "problems_id", "Problema")


@register("changes_report", O.with_fixtures(CHANGES_SQL))
def changes_report(t: Tables) -> DataFrame:
    """R06."""
    return R.changes_report(t, PERIOD)


@register("problems_report", O.with_fixtures(PROBLEMS_SQL))
def problems_report(t: Tables) -> DataFrame:
    """R07."""
    return R.problems_report(t, PERIOD)


COMBINED_BODY = f"""
SELECT id, CAST(date AS DATE) AS date, {O.type_label_sql('type_code')} AS type, itilcategories_id,
       {O.clock_sql('close_secs')} AS close_delay_stat, {O.clock_sql('solve_secs')} AS solve_delay_stat,
       CAST(solvedate AS DATE) AS solvedate, nome_categoria, peso, nome_tecnico
FROM derived
UNION ALL
SELECT id, CAST(date AS DATE), type, itilcategories_id, CAST(close_delay_stat AS VARCHAR),
       CAST(solve_delay_stat AS VARCHAR), CAST(solvedate AS DATE), nome_categoria, peso, nome_tecnico
FROM ({CHANGES_SQL}) ch
UNION ALL
SELECT id, CAST(date AS DATE), type, itilcategories_id, CAST(close_delay_stat AS VARCHAR),
       CAST(solve_delay_stat AS VARCHAR), CAST(solvedate AS DATE), nome_categoria, peso, nome_tecnico
FROM ({PROBLEMS_SQL}) pr
"""


@register(
    "combined_report",
    O.with_fixtures(COMBINED_BODY, O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)])),
)
def combined_report(t: Tables) -> DataFrame:
    """Tickets (common allow-list) + changes + problems."""
    return R.combined_report(t, PERIOD)


COMBINED_FULL_BODY = f"""
SELECT * FROM ({_full_body(["solucao"])}) tk
UNION ALL BY NAME
SELECT id, CAST(date AS DATE) AS date, itilcategories_id, CAST(close_delay_stat AS VARCHAR) AS close_delay_stat,
       CAST(solve_delay_stat AS VARCHAR) AS solve_delay_stat, CAST(solvedate AS DATE) AS solvedate,
       nome_tecnico, nome_categoria, peso, type
FROM ({CHANGES_SQL}) ch
UNION ALL BY NAME
SELECT id, CAST(date AS DATE) AS date, itilcategories_id, CAST(close_delay_stat AS VARCHAR) AS close_delay_stat,
       CAST(solve_delay_stat AS VARCHAR) AS solve_delay_stat, CAST(solvedate AS DATE) AS solvedate,
       nome_tecnico, nome_categoria, peso, type
FROM ({PROBLEMS_SQL}) pr
"""


@register(
    "combined_report_full",
    O.with_fixtures(
        rounded_sql(COMBINED_FULL_BODY, _full_doubles(["solucao"])),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]),
    ),
)
def combined_report_full(t: Tables) -> DataFrame:
    """R09 as the batch script calls it: every graded ticket column kept."""
    return R.combined_report(t, PERIOD, clean_tickets=False)


# -- R10 observers ---------------------------------------------------------------------

OBSERVED_CTE = f"""{O.mean_cte("obs_baseline", O.FIRST_DAY, O.FINAL)},
obs_pairs AS (
  SELECT tickets_id AS id, firstname AS nome_observador
  FROM tickets_users, users
  WHERE type = 3 AND users.id = users_id AND groups_id IN (1, 2) AND users.id <> 6 AND firstname IS NOT NULL
    AND tickets_id IN (SELECT id FROM tickets WHERE date >= {O.FIRST_DAY} AND date < {O.FINAL} + INTERVAL 1 DAY)
  GROUP BY ALL
),
obs_staff AS ({O.staff_sql("tickets_users", "tickets_id")}),
obs_items AS (
  SELECT * FROM tickets WHERE status IN (5, 6) AND date >= {O.INITIAL} AND date < {O.FINAL} + INTERVAL 1 DAY
),
obs_named AS ({O.with_staff("obs_items", "obs_staff")}),
observed AS (
  SELECT * EXCLUDE (person, watchers), person AS nome_tecnico,
         unnest(coalesce(watchers, [NULL])) AS nome_observador,
         {O.looked_up("categories", "name", "id", "itilcategories_id")} AS nome_categoria,
         {O.looked_up("request_types", "name", "id", "requesttypes_id")} AS origem,
         {O.looked_up("obs_baseline", "avg_close", "category", "itilcategories_id")} AS tempo_medio_fechamento,
         {O.looked_up("obs_baseline", "avg_solve", "category", "itilcategories_id")} AS tempo_medio_solucao
  FROM (SELECT *, (SELECT list(nome_observador) FROM obs_pairs p WHERE p.id = obs_named.id) AS watchers FROM obs_named) w
)"""


@register(
    "observed_report",
    O.with_fixtures(
        rounded_sql("SELECT * FROM observed", ["tempo_medio_fechamento", "tempo_medio_solucao"]), OBSERVED_CTE
    ),
)
def observed_report(t: Tables) -> DataFrame:
    """R10."""
    return R.observed_tickets(t, PERIOD)


OBSERVER_COUNTS_BODY = """
SELECT nome_observador, strftime(date, '%Y-%m') AS date2, count(id) AS id
FROM observed WHERE nome_observador IS NOT NULL GROUP BY 1, 2
"""


@register("observer_month_counts", O.with_fixtures(OBSERVER_COUNTS_BODY, OBSERVED_CTE))
def observer_month_counts(t: Tables) -> DataFrame:
    """A10."""
    return R.observer_month_counts(t, PERIOD)


@register(
    "technician_observer_summary",
    O.with_fixtures(
        rounded_sql(
            f"""
SELECT coalesce(s.nome, o.nome_observador) AS nome, coalesce(s.date2, o.date2) AS date2,
       s."Total de chamados", s."Total de atrasos", s."Tempo de solução médio",
       s."Diferença de tempo percentual em relação a média anual", s."Nota final",
       o.id AS chamados_observados
FROM (SELECT nome_tecnico AS nome, date2, count(DISTINCT id) AS "Total de chamados",
             CAST(count(DISTINCT CASE WHEN atraso THEN id END) AS BIGINT) AS "Total de atrasos",
             avg(solve_secs) / 86400.0 AS "Tempo de solução médio",
             round_even(avg(diferenca_media_vs_gasto_solucao), 4) AS "Diferença de tempo percentual em relação a média anual",
             avg(nota_final) AS "Nota final"
      FROM final WHERE nome_tecnico IS NOT NULL AND date2 IS NOT NULL GROUP BY 1, 2) s
FULL OUTER JOIN ({OBSERVER_COUNTS_BODY}) o ON s.nome = o.nome_observador AND s.date2 = o.date2
""",
            ["Tempo de solução médio", "Diferença de tempo percentual em relação a média anual", "Nota final"],
        ),
        O.ASSIGNED + ",\n" + O.derived_cte([("solucao", 1)]) + ",\n" + OBSERVED_CTE,
    ),
)
def technician_observer_summary(t: Tables) -> DataFrame:
    """Technician summary beside observer counts, full outer join."""
    return R.technician_observer_summary(t, PERIOD)


@register(
    "observer_pairs",
    O.with_fixtures("SELECT * FROM obs_pairs WHERE nome_observador IS NOT NULL", OBSERVED_CTE),
)
def observer_pairs(t: Tables) -> DataFrame:
    """A12/J08 right side: distinct (ticket, eligible observer name), baseline-to-date window."""
    from ..operators import enrich as E

    return E.observer_pairs(t.tickets, t, PERIOD.baseline_first, PERIOD.final)


# -- R11 whole run ----------------------------------------------------------------------

RUN_TODAY = "2000-06-15"  # mode "anual": 1999-07-01 .. 2000-06-30, baseline year 1999
RUN_INITIAL, RUN_FINAL = "DATE '1999-07-01'", "DATE '2000-06-30'"


@register(
    "run_all",
    O.with_fixtures(
        f"""
SELECT 'tickets' AS report, count(*) AS linhas FROM assigned_run
UNION ALL SELECT 'worklog', count(*) FROM worklog_run
UNION ALL SELECT 'accounts', count(*) FROM ({ACCOUNTS_BODY}) a
""",
        O.assigned_cte(RUN_INITIAL, RUN_FINAL, suffix="_run") + ",\n" + worklog_cte(RUN_INITIAL, RUN_FINAL, "_run"),
    ),
)
def run_all(t: Tables) -> DataFrame:
    """Tickets, worklog and accounts written as reports; row counts read back."""
    from ..session import fresh_path

    return R.run_all(t, fresh_path(t.spark, "run"), mode="anual", today=RUN_TODAY)


# The single-operator queries register themselves on import.
from . import catalog_operators  # noqa: E402,F401
