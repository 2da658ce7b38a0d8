"""Sources, sinks, session helpers and parameterised SQL."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from deskmetrics.functions.period import Period
from deskmetrics.plans import reports as R
from deskmetrics.plans.sql import run_sql_report, sql_text
from deskmetrics.session import fresh_path, shared_dir
from deskmetrics.sources.sinks import read_report, schema_of, write_report, write_snapshot
from deskmetrics.sources.tables import JdbcSource, ParquetSource, Tables, load_table


def test_schema_of(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1))], "id long, name string, d date")
    assert schema_of(df) == [("id", "bigint"), ("name", "string"), ("d", "date")]


def test_jdbc_options_split_reads():
    src = JdbcSource(
        "jdbc:mysql://db:3306/desk",
        {"user": "u", "password": "p"},
        partition_bounds={"tickets": ("id", 1, 1_000_000)},
        num_partitions=32,
    )
    opts = src.options("tickets")
    assert opts["dbtable"] == "glpi_tickets"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == (
        "id",
        "1",
        "1000000",
        "32",
    )
    assert opts["user"] == "u"
    assert "partitionColumn" not in src.options("categories")
    assert src.options("categories")["dbtable"] == "glpi_itilcategories"
    assert "FROM glpi_users" in src.options("accounts")["dbtable"]


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        load_table(spark, "glpi_tickets", ParquetSource("/nowhere"))


def test_parquet_source_round_trip(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    root = fresh_path(spark, "tables")
    for name in ("categories", "request_types"):
        getattr(t, name).write.parquet(f"{root}/{name}.parquet")
    p = Tables(spark, ParquetSource(root))
    assert p.categories.count() == 24 and p.request_types.count() == 5


def test_report_sink_dates_day_first(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 3, 5), dt.datetime(2024, 3, 6, 7, 8))], "id long, d date, ts timestamp_ntz"
    )
    path = write_report(df, fresh_path(spark, "sink"))
    (row,) = read_report(spark, path).collect()
    assert (row["id"], row["d"], row["ts"]) == ("1", "05/03/2024", "06/03/2024")
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) >= 1


def test_snapshot_sink_keeps_types(spark):
    df = spark.createDataFrame([(1, 2.5)], "id long, x double")
    back = spark.read.parquet(write_snapshot(df, fresh_path(spark, "snap")))
    assert back.dtypes == [("id", "bigint"), ("x", "double")]


def test_shared_dir_follows_checkpoint_dir(spark):
    base = shared_dir(spark)
    assert fresh_path(spark, "x").startswith(base)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_sql_text_uses_named_markers():
    text = sql_text("changes")
    assert ":initial_date" in text and ":final_date" in text
    assert "%(" not in text


def test_sql_report_equals_dataframe_report(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    period = Period.of("1996-01-01", "2000-06-30")
    by_sql = run_sql_report(t, "tickets_assigned", period)
    by_df = R.assigned_tickets(t, period)
    assert by_sql.columns == by_df.columns
    assert by_sql.exceptAll(by_df).count() == 0 and by_df.exceptAll(by_sql).count() == 0


def test_run_all_writes_reports(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    root = fresh_path(spark, "run")
    counts = {r["report"]: r["linhas"] for r in R.run_all(t, root, mode="anual", today="2000-06-15").collect()}
    assert set(counts) == {"tickets", "worklog", "accounts"}
    assert counts["accounts"] == 96
    assert all(os.path.isdir(f"{root}/{n}") for n in counts)


@pytest.mark.parametrize("hot", [(), (2,), (1, 2, 77)])
def test_fan_out_equals_left_joins(spark, hot):
    """Two fan-outs on one key, with a condition on the second, whichever keys go apart."""
    from deskmetrics.operators.joins import FanOut, fan_out, hot_test

    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (2, "e"), (4, "f")], "id long, x string")
    many = spark.createDataFrame([(2, f"u{i}") for i in range(200)] + [(1, "v"), (9, "w"), (None, "z")], "k long, y string")
    more = spark.createDataFrame([(2, f"o{i}") for i in range(7)] + [(3, "p"), (4, "q"), (None, "r")], "k long, z string")
    steps = [FanOut(many, ["k"], ["y"]), FanOut(more, ["k"], ["z"], F.col("x") != "f", "y")]
    got = fan_out(left, ["id"], steps, hot_test(hot))
    want = left.join(many, left["id"] == many["k"], "left").select(left["id"], left["x"], many["y"])
    want = want.join(more, (want["id"] == more["k"]) & (want["x"] != "f"), "left").select(want["id"], want["x"], want["y"], more["z"])
    assert got.columns == ["id", "x", "y", "z"]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 1 + 2 * 200 * 7 + 3


def test_second_fan_out_rides_on_the_first(spark):
    """Without hot keys each right side is shuffled once, and the rows once for both joins."""
    from deskmetrics.operators.joins import FanOut, fan_out

    left, right = spark.range(50), spark.range(200).select((F.col("id") % 40).alias("k"), F.col("id").alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fan_out(left, ["id"], [FanOut(right, ["k"], ["y"]), FanOut(right.withColumnRenamed("y", "z"), ["k"], ["z"])]).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert buf.getvalue().count("Exchange hashpartitioning") == 3


def test_ticket_report_outputs_share_one_grading(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    period = Period.of("1996-01-01", "2000-06-30")
    rep = R.TicketReport(t, period)
    assert rep.full().count() == rep.detail().count() == 1173
    assert rep.summary().count() == 473
    assert rep.graded is rep.graded
    assert set(rep.detail().columns) <= set(rep.full().columns)
    assert rep.summary().exceptAll(R.technician_month_summary(t, period)).count() == 0


def test_command_line_batch_run(spark, capsys):
    import json

    from deskmetrics.__main__ import main

    out = fresh_path(spark, "cli")
    main(["--fixtures", SF_SMALL, "--out", out, "--mode", "anual", "--today", "2000-06-15", "--sequential"])
    lines = [json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")]
    assert {l["report"] for l in lines} == {"tickets", "worklog", "accounts"}
    assert {l["report"]: l["rows"] for l in lines}["accounts"] == 96


def test_parquet_source_with_declared_schema(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    root = fresh_path(spark, "declared")
    t.categories.write.parquet(f"{root}/categories.parquet")
    src = ParquetSource(root, schemas={"categories": "id int, name string"})
    df = Tables(spark, src).categories
    assert df.dtypes == [("id", "int"), ("name", "string")] and df.count() == 24


def test_run_all_concurrent_equals_sequential(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    a = R.run_all(t, fresh_path(spark, "par"), mode="anual", today="2000-06-15", parallel=True)
    b = R.run_all(t, fresh_path(spark, "seq"), mode="anual", today="2000-06-15", parallel=False)
    assert sorted(a.collect()) == sorted(b.collect())


def test_summary_report_keeps_business_labels(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    summary = R.technician_month_summary(t, Period.of("1996-01-01", "2000-06-30"))
    back = read_report(spark, write_report(summary, fresh_path(spark, "summary")))
    assert back.columns == summary.columns
    assert "Diferença de tempo percentual em relação a média anual" in back.columns
    assert back.count() == 473


def test_sql_report_with_an_open_period_is_an_error(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    for name in ("tickets_assigned", "tickets_observed", "changes", "problems", "worklog"):
        for period in (None, Period.of(None, None), Period.of("1996-01-01", None)):
            with pytest.raises(ValueError, match="needs a value"):
                run_sql_report(t, name, period)


def test_sql_views_leave_the_callers_views_alone(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    spark.range(3).createOrReplaceTempView("users")
    run_sql_report(t, "changes", Period.of("1996-01-01", "2000-06-30")).count()
    assert spark.table("users").count() == 3
    spark.catalog.dropTempView("users")


def test_summary_is_written_in_key_order(spark):
    import csv
    import glob

    t = Tables.fixtures(spark, SF_SMALL)
    period = Period.of("1996-01-01", "2000-06-30")
    out = fresh_path(spark, "ordered")
    R.run_all(t, out, period=period, reports=["ticket_summary", "worklog_summary"])
    for name in ("ticket_summary", "worklog_summary"):
        keys = []
        for part in sorted(glob.glob(f"{out}/{name}/part-*.csv")):
            with open(part, newline="", encoding="utf-8") as f:
                keys += [tuple(row[:2]) for row in list(csv.reader(f))[1:]]
        assert len(keys) > 50 and keys == sorted(keys)


def test_run_all_files_hold_the_reports(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    period = Period.of("1996-01-01", "2000-06-30")
    out = fresh_path(spark, "files")
    R.run_all(t, out, period=period, reports=["accounts", "changes"])
    accounts = read_report(spark, f"{out}/accounts").collect()
    want = R.account_growth_report(t).collect()
    assert sorted((r[0], int(r[1]), int(r[2])) for r in accounts) == sorted((r[0].strftime("%d/%m/%Y"), r[1], r[2]) for r in want)
    changes = read_report(spark, f"{out}/changes")
    got = changes.groupBy("id").count().collect()
    assert {(int(r[0]), r[1]) for r in got} == {(r[0], r[1]) for r in R.changes_report(t, period).groupBy("id").count().collect()}


def _plain_growth(rows):
    """(day, id) pairs -> day: (ids of the day, ids up to the day's largest)."""
    ids = {i for _, i in rows}
    days = {d: {i for e, i in rows if e == d} for d, _ in rows}
    return {d: (len(own), sum(i <= max(own) for i in ids)) for d, own in days.items()}


@pytest.mark.parametrize("gap", [1, 1_000_003])
def test_account_growth_of_any_ids(spark, gap):
    """Dense or sparse ids, ids on several days, equal tops, one id that fills the table."""
    import datetime as dt
    import random

    from deskmetrics.operators import accounts as A

    rng = random.Random(gap)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(40)), rng.randrange(-200, 900) * gap) for _ in range(700)]
    rows += [(dt.date(2024, 3, 1), 5 * gap)] * 900 + [(dt.date(2024, 3, d), 901 * gap) for d in (2, 3)]
    df = spark.createDataFrame([(dt.datetime.combine(d, dt.time(9)), i) for d, i in rows], "date_creation timestamp_ntz, id long")
    df = df.select("*", F.lit(1).alias("is_active"), F.lit(0).alias("is_deleted"))
    bad = spark.createDataFrame([(None, 1, 1, 0), (dt.datetime(2030, 1, 1), None, 1, 0), (dt.datetime(2030, 1, 1), 7, 0, 0)], df.schema)
    got = {r["data"]: (r["novas_contas"], r["total_contas"]) for r in A.account_growth(df.unionByName(bad).repartition(5)).collect()}
    assert got == _plain_growth(rows)
    assert A.account_growth(bad).collect() == []


def test_account_growth_shuffles_accounts_once(spark):
    from deskmetrics.operators import accounts as A

    df = spark.range(500).select((F.col("id") * 3).alias("id"), F.timestamp_seconds(F.col("id") * 9_999).cast("timestamp_ntz").alias("date_creation"), F.lit(1).alias("is_active"), F.lit(0).alias("is_deleted"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        A.account_growth(df).explain()
    p = buf.getvalue()
    assert p.count("hashpartitioning(id#") == 1 and "rangepartitioning" not in p and "Scan parquet" not in p
    # The only others: counts per day and step, and the running sum over them.
    assert p.count("Exchange ") == 3 and p.count("Exchange SinglePartition") == 1


def test_command_line_window_reports_and_bounds(spark):
    from deskmetrics.__main__ import parse_args

    a = parse_args("--jdbc-url jdbc:x --out o --initial 2024-01-01 --final 2024-02-01 --report changes --jdbc-bounds tickets:id:1:9".split())
    assert (a.initial.month, a.final.month, a.report, a.jdbc_bounds) == (1, 2, ["changes"], ["tickets:id:1:9"])
    for bad in ("--initial 2024-01-01", "--jdbc-bounds tickets:id"):
        with pytest.raises(SystemExit):
            parse_args(["--parquet", "p", "--out", "o", *bad.split()])
