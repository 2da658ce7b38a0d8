"""Reports of one run share their stages; day sums fold into any window; ordered results carry their order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_plans import plan, scans
from deskmetrics.functions.period import Period
from deskmetrics.operators import enrich as E
from deskmetrics.plans import reports as R
from deskmetrics.plans.catalog import PERIOD
from deskmetrics.session import fresh_path
from deskmetrics.sources.sinks import read_report
from deskmetrics.sources.tables import Tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reports_from_shared_stages_equal_single_ones(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    stages = R.Stages(t, PERIOD)
    assert same(R.S.drop_hidden(stages.graded), R.graded_tickets_full(t, PERIOD))
    assert same(R.observed_tickets(t, PERIOD, stages), R.observed_tickets(t, PERIOD))
    assert same(R.technician_month_summary(t, PERIOD, stages=stages), R.technician_month_summary(t, PERIOD))


def test_tickets_are_read_once_for_all_reports_of_a_run(spark):
    """Tickets, observed tickets and their summary: tickets meet their assignees, and are summed up by day, once each."""

    class Counting(Tables):
        asked = []

        def __getattr__(self, name):
            if not name.startswith("_"):
                self.asked.append(name)
            return super().__getattr__(name)

    t = Counting(spark, Tables.fixtures(spark, SF_SMALL).source)
    stages = R.Stages(t, PERIOD)
    one = [stages.assigned, stages.days]
    plans = [plan(R.observed_tickets(t, PERIOD, stages)), plan(stages.graded), plan(R.technician_month_summary(t, PERIOD, stages=stages))]
    assert stages.assigned is one[0] and stages.days is one[1]
    for p in plans:
        # What still reads tickets are their ids, for the observers' bridge: no dates other than the filter's, no totals.
        assert all("o_totalprice" not in read for _, read in scans(p, "orders"))
    out = fresh_path(spark, "run")
    names = ["tickets", "observed", "ticket_summary"]
    counts = {r["report"]: r["linhas"] for r in R.run_all(t, out, period=PERIOD, reports=names).collect()}
    alone = Tables.fixtures(spark, SF_SMALL)
    want = [R.graded_tickets_full(alone, PERIOD), R.observed_tickets(alone, PERIOD), R.technician_month_summary(alone, PERIOD)]
    assert counts == {n: df.count() for n, df in zip(names, want)}
    assert read_report(spark, f"{out}/observed").count() == counts["observed"]


@pytest.mark.parametrize("first,last", [("1998-01-01", "1998-12-31"), ("1997-03-05", "1999-11-30"), ("1998-06-01", "1998-06-01"), ("2030-01-01", "2030-02-01")])
def test_any_window_folds_from_the_days_of_a_larger_one(spark, first, last):
    t = Tables.fixtures(spark, SF_SMALL)
    lk = E.Lookups.of(t, needed=("categories",))
    days = E.category_days(t.tickets, "1997-01-01", "2000-12-31")
    first, last = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    got = {r[0]: r[1:] for r in E.fold_days(days, lk, first, last).collect()}
    plain = (
        t.tickets.filter(F.to_date("date").between(F.lit(first), F.lit(last)))
        .join(t.categories, F.col("itilcategories_id") == t.categories["id"], "left_semi")
        .groupBy("itilcategories_id").agg(F.avg("close_delay_stat"), F.avg("solve_delay_stat"))
    )
    want = {r[0]: r[1:] for r in plain.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_means_of_missing_delays(spark):
    rows = [(1, dt.datetime(2024, 1, 1), None, 10), (1, dt.datetime(2024, 1, 2), None, None), (2, dt.datetime(2024, 1, 1), 4, None), (9, dt.datetime(2024, 1, 1), 5, 5), (None, dt.datetime(2024, 1, 1), 5, 5)]
    tickets = spark.createDataFrame(rows, "itilcategories_id int, date timestamp_ntz, close_delay_stat long, solve_delay_stat long")
    cats = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    lk = E.Lookups(cats, True, cats, False, cats, False)
    got = {r[0]: (r[1], r[2]) for r in E.category_baseline(tickets, lk, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).collect()}
    assert got == {1: (None, 10.0), 2: (4.0, None)}


@pytest.mark.parametrize("rows", [1, 40, 100_000])
def test_positions_follow_the_keys_over_pieces(spark, rows, monkeypatch):
    monkeypatch.setattr(R, "ORDERED_ROWS", rows)
    keys = [(f"t{i * 37 % 60:02d}", f"2024-{1 + i % 2:02d}") for i in range(120)]
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "nome string, mes string, n long").repartition(5)
    got = R.with_position(df).collect()
    assert [(r["nome"], r["mes"]) for r in sorted(got, key=lambda r: r["posicao"])] == sorted(keys)
    assert sorted(r["posicao"] for r in got) == list(range(1, 121))
    assert R.with_position(df.limit(0)).collect() == []


def test_run_without_bounds_reads_whole_bridges(spark):
    t = Tables.fixtures(spark, SF_SMALL)
    whole = Period.of("", "")
    assert "__keep" not in plan(R.with_assignees(t, whole)) and R.changes_report(t, whole).count() > 0
    assert R.combined_report(t, whole).count() == sum(df.count() for df in (R.tickets_for_combining(t, whole), R.changes_report(t, whole), R.problems_report(t, whole)))
