"""Hand-computed edge rows (FIXTURES.md §4) against the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from deskmetrics.functions import expressions as X
from deskmetrics.functions.period import Period, default_period, period_for_mode
from deskmetrics.operators import accounts as A
from deskmetrics.operators import scoring as S
from deskmetrics.operators import worklog as W
from deskmetrics.plans import reports as R
from deskmetrics.sources.tables import Source, Tables

D = dt.date
TS = dt.datetime

GRADE_SCHEMA = "id long, date date, nome_tecnico string, peso int, tempo_medio_solucao double, tempo_solucao double, atraso boolean"


def graded(spark, rows, config=None):
    df = spark.createDataFrame(rows, GRADE_SCHEMA)
    return {r["id"]: r for r in S.grade_tickets(df, config or S.ScoreConfig()).collect()}


def test_month_with_one_ticket_has_no_grade(spark):
    out = graded(spark, [(1, D(2024, 1, 5), "Ana", 3, 1.0, 0.5, False)])
    assert out[1]["delta_tempo_solucao_normalized"] is None
    assert out[1]["nota_final"] is None


def test_month_with_one_technician_has_no_bonus(spark):
    out = graded(
        spark,
        [(1, D(2024, 1, 5), "Ana", 3, 1.0, 0.5, False), (2, D(2024, 1, 6), "Ana", 3, 1.0, 0.9, False)],
    )
    assert out[1]["bonus"] is None and out[1]["nota_final"] is None


def test_volume_bonus_ends(spark):
    rows = [(1, D(2024, 1, 1), "Ana", 3, 1.0, 0.5, False)] + [
        (i, D(2024, 1, i), "Bia", 3, 1.0, 0.1 * i, False) for i in (2, 3, 4)
    ]
    out = graded(spark, rows)
    assert out[1]["qtde_chamados"] == 1 and out[1]["bonus"] == pytest.approx(0.8)
    assert out[2]["qtde_chamados"] == 3 and out[2]["bonus"] == pytest.approx(1.2)


def test_clip_and_month_grade(spark):
    # mean 1 day; deltas -5, 0.1 and 3 days
    rows = [
        (1, D(2024, 1, 1), "Ana", 3, 1.0, 6.0, False),
        (2, D(2024, 1, 2), "Bia", 3, 1.0, 0.9, False),
        (3, D(2024, 1, 3), "Cid", 3, 4.0, 1.0, False),
    ]
    out = graded(spark, rows)
    assert [out[i]["delta_tempo_solucao"] for i in (1, 2, 3)] == pytest.approx([-1.0, 0.1, 0.4])
    assert [out[i]["delta_tempo_solucao_normalized"] for i in (1, 2, 3)] == pytest.approx(
        [3.0, 3 + 5 * 1.1 / 1.4, 8.0]
    )


def test_missing_or_zero_category_mean(spark):
    rows = [
        (1, D(2024, 1, 1), "Ana", 3, None, 0.5, False),
        (2, D(2024, 1, 2), "Ana", 3, 0.0, 0.5, False),
    ]
    out = graded(spark, rows)
    assert out[1]["delta_tempo_solucao"] is None
    assert out[2]["delta_tempo_solucao"] == pytest.approx(-0.5)
    assert out[2]["diferenca_media_vs_gasto_solucao"] is None


def test_null_technician_volume(spark):
    rows = [
        (1, D(2024, 1, 1), None, 3, 1.0, 0.5, False),
        (2, D(2024, 1, 2), None, 3, 1.0, 0.5, False),
        (3, D(2024, 1, 3), "Ana", 3, 1.0, 0.5, False),
        (4, D(2024, 1, 4), "Bia", 3, 1.0, 0.5, False),
        (5, D(2024, 1, 5), "Bia", 3, 1.0, 0.5, False),
    ]
    out = graded(spark, rows)
    assert out[1]["qtde_chamados"] is None
    # the two null rows do not make a month minimum of 2: Ana (1) is the minimum
    assert out[3]["bonus"] == pytest.approx(0.8)
    assert out[4]["bonus"] == pytest.approx(1.2)


def test_two_assignees_same_first_name(spark):
    rows = [
        (1, D(2024, 1, 1), "Ana", 3, 1.0, 0.5, True),
        (1, D(2024, 1, 1), "Ana", 3, 1.0, 0.5, True),
        (2, D(2024, 1, 2), "Bia", 3, 1.0, 0.5, False),
    ]
    df = spark.createDataFrame(rows, GRADE_SCHEMA)
    g = S.grade_tickets(df, S.ScoreConfig())
    vols = {r["nome_tecnico"]: r["qtde_chamados"] for r in g.collect()}
    assert vols["Ana"] == 2
    summary = {r["nome_tecnico"]: r for r in S.technician_summary(g, S.ScoreConfig(), labels=False).collect()}
    assert summary["Ana"]["id"] == 1
    assert summary["Ana"]["Total de atrasos"] == 1


def test_final_grade_weight_factor(spark):
    df = spark.createDataFrame([(5, 5.0), (1, 5.0), (None, 5.0)], "peso int, g double")
    got = [r[0] for r in df.select(X.final_grade(F.col("g"), F.lit(1.0), F.col("peso"), 0.05)).collect()]
    assert got[0] == pytest.approx(5.5) and got[1] == pytest.approx(4.5) and got[2] is None


def test_two_metric_weighted_grade(spark):
    # close grade 3 (lowest delta), solve grade 6 via scaling -> (2*3 + 1*6) / 3 = 4
    rows = [
        (1, D(2024, 1, 1), "Ana", 3, 1.0, 2.0, 1.0, 1.0 - (-1 + 1.4 * 0.6), False),
        (2, D(2024, 1, 2), "Bia", 3, 1.0, 0.6, 1.0, 0.6, False),
        (3, D(2024, 1, 3), "Cid", 3, 1.0, 2.0, 1.0, 2.0, False),
    ]
    schema = (
        "id long, date date, nome_tecnico string, peso int, tempo_medio_fechamento double, "
        "tempo_fechamento double, tempo_medio_solucao double, tempo_solucao double, atraso boolean"
    )
    cfg = S.ScoreConfig(weights={"fechamento": 2, "solucao": 1})
    out = {r["id"]: r for r in S.grade_tickets(spark.createDataFrame(rows, schema), cfg).collect()}
    assert out[1]["delta_tempo_fechamento_normalized"] == pytest.approx(3.0)
    assert out[1]["delta_tempo_solucao_normalized"] == pytest.approx(6.0)
    assert out[1]["nota_final_tempos"] == pytest.approx(4.0)


def test_score_config_validation():
    with pytest.raises(ValueError):
        S.ScoreConfig(weights={"solucao": 1.5}).metrics()
    with pytest.raises(ValueError):
        S.ScoreConfig(weights={"solucao": 0}).metrics()
    with pytest.raises(ValueError):
        S.ScoreConfig(weights={"speed": 1}).metrics()
    assert S.ScoreConfig(weights={"close": 2, "solve": 0}).metrics() == [("fechamento", 2)]


def test_late_flag(spark):
    df = spark.createDataFrame(
        [
            (TS(2024, 1, 1, 10, 5), TS(2024, 1, 1, 10, 0)),
            (TS(2024, 1, 1, 9, 0), TS(2024, 1, 1, 10, 0)),
            (TS(2024, 1, 1, 9, 0), None),
            (None, TS(2024, 1, 1, 10, 0)),
        ],
        "s timestamp_ntz, d timestamp_ntz",
    )
    assert [r[0] for r in df.select(X.late_flag("s", "d")).collect()] == [True, False, False, False]


@pytest.mark.parametrize("tz", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_clock_text_ignores_time_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([(90000,), (None,), (59,), (-5,)], "s long")
        got = [r[0] for r in df.select(X.seconds_to_clock("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["01:00:00", None, "00:00:59", "23:59:55"]


def test_type_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "type int")
    assert [r[0] for r in df.select(X.type_label("type")).collect()] == ["Incidente", "Requisição", "3"]


def test_elected_time(spark):
    df = spark.createDataFrame(
        [(1, 0, 60), (2, None, 60), (3, 50, 60), (4, 2_000_000_000, 60)],
        "id long, tempo_via_plugin long, tempo_via_glpi long",
    )
    out = {r["id"]: r["tempo_eleito"] for r in W.elect_time(df).collect()}
    assert out == pytest.approx({1: 60 / 86400, 2: 60 / 86400, 3: 50 / 86400, 4: 60 / 86400})


def test_worklog_summary_all_null(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 2), "Ana", None)], "id long, ultima_modificacao date, tecnico_das_tarefas string, tempo_eleito double"
    )
    (row,) = W.worklog_summary(df, labels=False).collect()
    assert row["tempo_eleito"] == 0.0 and row["tempo_eleito2"] is None


class FrameSource(Source):
    def __init__(self, frames):
        self.frames = frames

    def load(self, spark, name):
        return self.frames[name]


def worklog_tables(spark, timers):
    frames = {
        "tickets": spark.createDataFrame([(10, 3)], "id long, itilcategories_id int"),
        "categories": spark.createDataFrame([(3, "Rede")], "id int, name string"),
        "category_weights": spark.createDataFrame([(3, 2)], "items_id int, pesofield int"),
        "request_types": spark.createDataFrame([(1, "Email")], "id int, name string"),
        "tasks": spark.createDataFrame(
            [(100, 10, TS(2024, 1, 2), 7, 60)],
            "id long, tickets_id long, date timestamp_ntz, users_id_tech long, actiontime long",
        ),
        "timers": spark.createDataFrame(
            timers, "tasks_id long, actual_begin timestamp_ntz, actual_end timestamp_ntz, actual_actiontime long"
        ),
        "tickets_users": spark.createDataFrame([(10, 7, 2)], "tickets_id long, users_id long, type int"),
        "users": spark.createDataFrame([(7, "Ana", 1)], "id long, firstname string, groups_id int"),
    }
    return Tables(spark, FrameSource(frames))


def test_two_timers_same_day_repeat_manual_time(spark):
    t = worklog_tables(
        spark,
        [
            (100, TS(2024, 1, 2, 8), TS(2024, 1, 2, 9), None),
            (100, TS(2024, 1, 2, 10), TS(2024, 1, 2, 11), None),
        ],
    )
    (row,) = W.worklog_grouped(t, D(2024, 1, 1), D(2024, 1, 31)).collect()
    assert row["tempo_via_glpi"] == 120 and row["tempo_via_plugin"] is None


def test_timer_begun_before_period_is_dropped(spark):
    t = worklog_tables(spark, [(100, TS(2023, 12, 31, 23), TS(2024, 1, 1, 1), 30)])
    assert W.worklog_grouped(t, D(2024, 1, 1), D(2024, 1, 31)).count() == 0


def test_account_growth_small(spark):
    d1, d2 = TS(2024, 1, 1), TS(2024, 1, 2)
    acc = spark.createDataFrame(
        [(1, d1, 1, 0), (2, d2, 1, 0), (3, d1, 1, 0), (4, d2, 0, 0), (5, None, 1, 0)],
        "id long, date_creation timestamp_ntz, is_active int, is_deleted int",
    )
    out = {r["data"]: (r["novas_contas"], r["total_contas"]) for r in A.account_growth(acc).collect()}
    assert out == {D(2024, 1, 1): (2, 3), D(2024, 1, 2): (1, 2)}


def test_periods():
    p = Period.of("2023-05-01", "2024-02-10")
    assert (p.baseline_first, p.baseline_last) == (D(2023, 1, 1), D(2023, 12, 31))
    assert Period.of("", "").baseline_first is None
    assert default_period("2024-03-17") == Period(D(2023, 3, 2), D(2024, 3, 1))
    assert period_for_mode("geral", "2024-02-10") == Period(D(2019, 1, 1), D(2024, 2, 29))
    assert period_for_mode("anual", "2024-02-10") == Period(D(2023, 3, 1), D(2024, 2, 29))
    with pytest.raises(ValueError):
        period_for_mode("mensal", "2024-02-10")


def test_combined_typing(spark):
    tickets = spark.createDataFrame([(1, D(2024, 1, 1), 1, 3600)], "id long, date date, type int, close_delay_stat long")
    changes = spark.createDataFrame([(2, TS(2024, 1, 2, 5), 3600, 4)], "id int, date timestamp_ntz, close_delay_stat int, urgency int")
    out = R._common_form(tickets, "tickets").unionByName(R._common_form(changes, "changes"), allowMissingColumns=True)
    rows = {r["id"]: r for r in out.collect()}
    assert (rows[1]["close_delay_stat"], rows[1]["type"], rows[1]["urgency"]) == ("01:00:00", "Incidente", None)
    assert (rows[2]["close_delay_stat"], rows[2]["type"], rows[2]["date"]) == ("3600", "Mudança", D(2024, 1, 2))
    assert dict(out.dtypes) == {"id": "bigint", "date": "date", "type": "string", "close_delay_stat": "string", "urgency": "int"}


def test_exclusion_before_month_bounds(spark):
    """Excluding a technician removes their rows before the month range is taken, so the
    others' grades move; rows without a technician stay."""
    rows = [
        (1, TS(2024, 1, 1), 3, "Ana", 86400, 172800),
        (2, TS(2024, 1, 2), 3, "Pedro", 86400 * 10, 172800),
        (3, TS(2024, 1, 3), 3, None, 43200, 172800),
        (4, TS(2024, 1, 4), 3, "Bia", 0, 172800),
    ]
    df = spark.createDataFrame(
        rows, "id long, date timestamp_ntz, peso int, nome_tecnico string, solve_delay_stat long, mean_secs long"
    ).select(
        "id", "date", "peso", "nome_tecnico",
        F.col("solve_delay_stat"), F.col("solve_delay_stat").alias("close_delay_stat"),
        F.lit(None).cast("timestamp_ntz").alias("solvedate"), F.lit(None).cast("timestamp_ntz").alias("time_to_resolve"),
        F.lit(1).alias("type"),
        F.col("mean_secs").cast("double").alias("tempo_medio_fechamento"),
        F.col("mean_secs").cast("double").alias("tempo_medio_solucao"),
    )
    cfg_all = S.ScoreConfig()
    cfg_ex = S.ScoreConfig(exclude_technicians=("Pedro",))
    g_all = {r["id"]: r for r in S.grade_tickets(S.derive_ticket_columns(df), cfg_all).collect()}
    g_ex = {r["id"]: r for r in S.grade_tickets(S.derive_ticket_columns(df, cfg_ex.exclude_technicians), cfg_ex).collect()}
    assert 2 not in g_ex and 3 in g_ex
    # clipped deltas (mean 2 days): Ana 1 -> 0.4, Pedro -8 -> -1, no technician 1.5 -> 0.4, Bia 2 -> 0.4
    assert g_all[1]["min_mes_solucao"] == pytest.approx(-1.0)
    assert g_ex[1]["min_mes_solucao"] == pytest.approx(0.4)
    assert g_all[1]["delta_tempo_solucao_normalized"] != g_ex[1]["delta_tempo_solucao_normalized"]
