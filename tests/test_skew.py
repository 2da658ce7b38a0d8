"""A ticket holding most of the bridge rows is found and dealt out; other hot keys are split by AQE.

Thresholds are lowered so a few thousand rows count as skewed on a laptop."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from deskmetrics.operators.enrich import join_assignee

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.deskmetrics.fanout.hotRows": "1000",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_ticket_is_split(skew_session):
    spark = skew_session
    tickets = spark.range(0, 200).select(F.col("id"), F.lit(5).alias("status"))
    # ticket 7 holds three quarters of all bridge rows
    bridge = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit(7)).otherwise(F.col("id") % 200).alias("tickets_id"),
        (F.col("id") % 50).alias("users_id"),
        F.lit(2).alias("type"),
    )
    users = spark.range(0, 50).select(F.col("id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("firstname"))
    df = join_assignee(tickets, bridge, users, "tickets_id")
    rows = df.collect()
    plain = tickets.join(bridge.filter("type = 2"), tickets["id"] == bridge["tickets_id"], "left")
    assert len(rows) == plain.count() == 20000
    assert _tasks_of(df, 7) >= 4


def _tasks_of(df, ticket):
    """Tasks that produce rows of a ticket; none has more than half of them."""
    rows = df.filter(F.col("id") == ticket).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert max(r["count"] for r in rows) <= sum(r["count"] for r in rows) / 2
    return len(rows)


def _hot_month_detail(spark):
    return spark.range(0, 20000).select(
        F.col("id"),
        F.when(F.col("id") < 15000, F.lit("2024-01-10")).otherwise(F.lit("2024-02-10")).cast("date").alias("date"),
        F.when(F.col("id") < 15000, F.lit("Ana")).otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias(
            "nome_tecnico"
        ),
        F.lit(3).alias("peso"),
        F.lit(1.0).alias("tempo_medio_solucao"),
        ((F.col("id") % 17) / 10.0).alias("tempo_solucao"),
        F.lit(False).alias("atraso"),
    )


def _summary_plan(spark):
    from deskmetrics.operators import scoring as S

    g = S.grade_tickets(_hot_month_detail(spark), S.ScoreConfig())
    out = S.technician_summary(g, S.ScoreConfig(), labels=False)
    rows = {(r["nome_tecnico"], r["date2"]): r for r in out.collect()}
    assert rows[("Ana", "2024-01")]["id"] == 15000
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    return buf.getvalue()


def test_hot_technician_month_is_split(skew_session):
    """A (month, technician) lookup beyond the broadcast limit: both sides are shuffled
    and the hot technician-month is split."""
    spark = skew_session
    spark.conf.set("spark.deskmetrics.broadcast.maxRows", "0")
    try:
        plan = _summary_plan(spark)
    finally:
        spark.conf.unset("spark.deskmetrics.broadcast.maxRows")
    assert "SortMergeJoin(skew=true)" in plan


def test_small_lookup_is_broadcast(skew_session):
    """Within the limit the lookup is broadcast: the detail rows are not shuffled to meet it."""
    plan = _summary_plan(skew_session)
    assert "hashpartitioning(date2" not in plan
    assert "BroadcastHashJoin" in plan


def test_hot_task_is_split_in_the_worklog(skew_session):
    import datetime as dt

    from deskmetrics.operators.worklog import worklog_grouped
    from deskmetrics.sources.tables import Source, Tables

    spark = skew_session

    class Frames(Source):
        def __init__(self, frames):
            self.frames = frames

        def load(self, spark, name):
            return self.frames[name]

    start = F.lit(dt.datetime(2024, 1, 2, 8)).cast("timestamp_ntz")
    timers = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit(1000)).otherwise(1000 + F.col("id") % 300).alias("tasks_id"),
        start.alias("actual_begin"),
        F.timestamp_add("SECOND", F.lit(60), start).alias("actual_end"),
        F.lit(60).cast("bigint").alias("actual_actiontime"),
    )
    tasks = spark.range(1000, 1300).select(
        F.col("id"),
        (F.col("id") % 50).alias("tickets_id"),
        start.alias("date"),
        (1 + F.col("id") % 7).alias("users_id_tech"),
        F.lit(60).cast("bigint").alias("actiontime"),
    )
    frames = {
        "timers": timers,
        "tasks": tasks,
        "tickets": spark.range(0, 50).select(F.col("id"), F.lit(1).alias("itilcategories_id")),
        "categories": spark.createDataFrame([(1, "Rede")], "id int, name string"),
        "category_weights": spark.createDataFrame([(1, 3)], "items_id int, pesofield int"),
        "request_types": spark.createDataFrame([(1, "Email")], "id int, name string"),
        "tickets_users": spark.range(0, 50).select(F.col("id").alias("tickets_id"), F.lit(1).cast("long").alias("users_id"), F.lit(2).alias("type")),
        "users": spark.range(0, 10).select(F.col("id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("firstname")),
    }
    df = worklog_grouped(Tables(spark, Frames(frames)), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    rows = df.collect()
    assert sum(r["tempo_via_plugin"] for r in rows) == 20000 * 60
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "SortMergeJoin(skew=true)" in buf.getvalue()


class Frames:
    def __init__(self, frames):
        self.frames = frames

    def load(self, spark, name):
        return self.frames[name]


def _hot_desk(spark):
    """Ticket 7 holds most bridge rows, most observers and most worked days."""
    import datetime as dt

    from deskmetrics.sources.tables import Tables

    day = F.lit(dt.datetime(2024, 1, 2, 8)).cast("timestamp_ntz")
    hot = F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id") % 200).cast("long")
    items = spark.range(0, 200).select(
        "id", day.alias("date"), F.lit(5).alias("status"), F.lit(1).alias("type"), F.lit(1).alias("itilcategories_id"),
        F.lit(1).alias("requesttypes_id"), F.lit(60).cast("long").alias("close_delay_stat"), F.lit(60).cast("long").alias("solve_delay_stat"),
        day.alias("solvedate"), day.alias("time_to_resolve"),
    )
    bridge = spark.range(0, 4000).select(hot.alias("item"), (10 + F.col("id") % 3000).alias("users_id"), F.lit(2).alias("type"))
    watch = spark.range(0, 4000).select(hot.alias("item"), (100 + F.col("id")).alias("users_id"), F.lit(3).alias("type"))
    bridge = bridge.union(watch.filter("item = 7 AND users_id % 60 = 0 OR item <> 7"))
    bridge = bridge.select(F.col("item").alias("tickets_id"), "users_id", "type")
    tasks = spark.range(0, 4000).select("id", hot.alias("tickets_id"), day.alias("date"), (1 + F.col("id") % 500).alias("users_id_tech"), F.lit(60).cast("long").alias("actiontime"))
    timers = spark.range(0, 4000).select(
        F.col("id").alias("tasks_id"), day.alias("actual_begin"),
        F.timestamp_add("DAY", (F.col("id") / 500).cast("int"), day).alias("actual_end"), F.lit(60).cast("long").alias("actual_actiontime"),
    )
    frames = {
        "tickets": items, "changes": items, "problems": items, "tickets_users": bridge, "tasks": tasks, "timers": timers,
        "changes_users": bridge.withColumnRenamed("tickets_id", "changes_id"), "problems_users": bridge.withColumnRenamed("tickets_id", "problems_id"),
        "categories": spark.createDataFrame([(1, "Rede")], "id int, name string"),
        "category_weights": spark.createDataFrame([(1, 3)], "items_id int, pesofield int"),
        "request_types": spark.createDataFrame([(1, "Email")], "id int, name string"),
        "users": spark.range(1, 5000).select("id", F.concat(F.lit("u"), F.col("id").cast("string")).alias("firstname"), F.lit(1).alias("groups_id")),
    }
    return Tables(spark, Frames(frames))


def _skewed_joins(df):
    rows = df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return rows, buf.getvalue().split("== Initial Plan ==")[0].count("SortMergeJoin(skew=true)")


@pytest.mark.parametrize("name", ["assigned", "observed", "worklog", "changes", "sql:tickets_assigned", "sql:tickets_observed", "sql:changes", "sql:problems", "sql:worklog"])
def test_hot_ticket_is_split_in_the_reports(skew_session, name):
    from deskmetrics.functions.period import Period
    from deskmetrics.plans import reports as R
    from deskmetrics.plans.sql import run_sql_report

    t = _hot_desk(skew_session)
    period = Period.of("2024-01-01", "2024-01-31")
    if name.startswith("sql:"):
        df = run_sql_report(t, name[4:], period)
    else:
        df = {"assigned": R.assigned_tickets, "observed": R.observed_tickets, "changes": R.changes_report, "worklog": R.worklog_report}[name](t, period)
    rows, split = _skewed_joins(df)
    assert len(rows) > 2000
    if name.startswith("sql:"):
        # Both fan-outs of the observed report, else the one on the ticket.
        assert split >= (2 if "observed" in name else 1)
    else:
        assert sum(r["id"] == 7 for r in rows) > 1000
        assert _tasks_of(df, 7) >= 4


def test_heavy_keys(skew_session):
    from deskmetrics.operators.hotkeys import Hot, heavy_keys

    df = skew_session.range(0, 30000).select(
        F.when(F.col("id") < 9000, 7).when(F.col("id") < 11000, 8).when(F.col("id") < 11900, 9).when(F.col("id") < 12000, None).otherwise(F.col("id")).cast("long").alias("k")
    )
    assert heavy_keys(df, "k") == Hot(30000, (7, 8))
    assert heavy_keys(df.limit(0), "k") == Hot(0, ())


def test_hot_items_are_looked_up_once(skew_session):
    from deskmetrics.operators.enrich import hot_items

    t = _hot_desk(skew_session)
    assert hot_items(t, "tickets_users", "tickets_id").keys == (7,)
    t.source.frames["tickets_users"] = None
    t._cache.clear()
    assert hot_items(t, "tickets_users", "tickets_id").keys == (7,)


@pytest.mark.parametrize("name", ["assigned", "observed", "changes", "combined"])
def test_hot_items_change_no_row(skew_session, name):
    from deskmetrics.functions.period import Period
    from deskmetrics.plans import reports as R

    period = Period.of("2024-01-01", "2024-01-31")
    build = {"assigned": R.assigned_tickets, "observed": R.observed_tickets, "changes": R.changes_report, "combined": R.combined_report}[name]
    apart = build(_hot_desk(skew_session), period)
    skew_session.conf.set("spark.deskmetrics.fanout.hotRows", "1000000")
    plain = build(_hot_desk(skew_session), period)
    assert apart.exceptAll(plain).count() == 0 and plain.exceptAll(apart).count() == 0
