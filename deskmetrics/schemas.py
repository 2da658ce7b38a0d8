"""Table layouts, column allow-lists and labels.

Everything under "Fixed values" must equal what the original reports produce, so a
user switching over gets the same column names, labels and tags.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the original reports exactly)
# ---------------------------------------------------------------------------

# Database table behind each logical table name (JDBC source).
DATABASE_TABLES = {
    "tickets": "glpi_tickets",
    "tasks": "glpi_tickettasks",
    "timers": "glpi_plugin_actualtime_tasks",
    "tickets_users": "glpi_tickets_users",
    "users": "glpi_users",
    "accounts": "glpi_users",
    "categories": "glpi_itilcategories",
    "category_weights": "glpi_plugin_fields_itilcategorypesos",
    "request_types": "glpi_requesttypes",
    "changes": "glpi_changes",
    "changes_users": "glpi_changes_users",
    "problems": "glpi_problems",
    "problems_users": "glpi_problems_users",
}

# Status codes of a finished item (solved, closed).
FINISHED_STATUSES = (5, 6)

# Bridge roles.
ROLE_ASSIGNED = 2
ROLE_OBSERVER = 3

# Ticket type code -> label; other codes are shown as their number.
TYPE_LABELS = {1: "Incidente", 2: "Requisição"}

# Tag written into the type column of the change and problem reports.
CHANGE_TAG = "Mudança"
PROBLEM_TAG = "Problema"

# Metric suffixes used in the graded columns, with English aliases accepted by ScoreConfig.
METRIC_ALIASES = {"close": "fechamento", "solve": "solucao"}

# Columns kept by the clean graded-ticket detail, in this order of preference.
DETAIL_COLUMNS = [
    "id",
    "date",
    "type",
    "locations_id",
    "nome_categoria",
    "peso",
    "origem",
    "nome_tecnico",
    "tempo_medio_fechamento",
    "tempo_medio_solucao",
    "tempo_fechamento",
    "tempo_solucao",
    "atraso",
    "nota_final_tempos",
    "delta_tempo_solucao",
    "diferenca_media_vs_gasto_solucao",
    "nota_final",
]

# Columns kept by the ticket, change and problem reports meant for the combined report.
COMMON_COLUMNS = [
    "id",
    "name",
    "entities_id",
    "date",
    "closedate",
    "solvedate",
    "date_mod",
    "users_id_lastupdater",
    "users_id_recipient",
    "urgency",
    "impact",
    "priority",
    "itilcategories_id",
    "type",
    "begin_waiting_date",
    "waiting_duration",
    "close_delay_stat",
    "solve_delay_stat",
    "nome_tecnico",
    "nome_categoria",
    "peso",
]

# Business names of the technician-month summary columns.
SUMMARY_LABELS = {
    "nome_tecnico": "Técnico",
    "date2": "Data",
    "id": "Total de chamados",
    "tempo_solucao": "Tempo de solução médio",
    "diferenca_media_vs_gasto_solucao": "Diferença de tempo percentual em relação a média anual",
    "nota_final": "Nota final",
}
LATE_TOTAL_LABEL = "Total de atrasos"

# Business names of the worklog month summary columns.
WORKLOG_SUMMARY_LABELS = {
    "tecnico_das_tarefas": "Técnico",
    "id": "Número de chamados",
    "data_mes": "Data",
    "tempo_eleito": "Total tempo trabalhado GLPI",
    "tempo_eleito2": "Média tempo trabalhado GLPI (por chamado)",
}

# Worklog totals above this many seconds are treated as bogus and reset to 0.
WORKLOG_OUTLIER_SECONDS = 1_000_000_000

# Start of the whole-history report period.
WHOLE_HISTORY_START = "2019-01-01"

# ---------------------------------------------------------------------------
# Input layouts (columns the reports read; further columns pass through)
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", TS),
        T.StructField("status", T.IntegerType()),
        T.StructField("type", T.IntegerType()),
        T.StructField("itilcategories_id", T.IntegerType()),
        T.StructField("requesttypes_id", T.IntegerType()),
        T.StructField("close_delay_stat", T.LongType()),
        T.StructField("solve_delay_stat", T.LongType()),
        T.StructField("solvedate", TS),
        T.StructField("time_to_resolve", TS),
    ]
)

# Changes and problems carry the shared item columns without ticket-only ones.
CHANGE_COLUMNS = [
    "id",
    "date",
    "status",
    "itilcategories_id",
    "close_delay_stat",
    "solve_delay_stat",
    "solvedate",
]

TABLE_COLUMNS = {
    "tickets": [f.name for f in ITEM_SCHEMA.fields],
    "changes": CHANGE_COLUMNS,
    "problems": CHANGE_COLUMNS,
    "tickets_users": ["tickets_id", "users_id", "type"],
    "changes_users": ["changes_id", "users_id", "type"],
    "problems_users": ["problems_id", "users_id", "type"],
    "users": ["id", "firstname", "groups_id"],
    "accounts": ["id", "date_creation", "is_active", "is_deleted"],
    "categories": ["id", "name"],
    "category_weights": ["items_id", "pesofield"],
    "request_types": ["id", "name"],
    "tasks": ["id", "tickets_id", "date", "users_id_tech", "actiontime"],
    "timers": ["tasks_id", "actual_begin", "actual_end", "actual_actiontime"],
}

TABLE_NAMES = tuple(TABLE_COLUMNS)
