"""Properties: expressions against plain Python on generated batches, bounds on real data."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_CHECK
from deskmetrics.functions import expressions as X
from deskmetrics.functions.period import Period
from deskmetrics.plans import reports as R
from deskmetrics.plans.catalog import tables_for

finite = st.floats(min_value=-50, max_value=50, allow_nan=False, allow_infinity=False)


def py_clip(x, lo, hi):
    return None if x is None else min(max(x, lo), hi)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), finite), finite, finite), min_size=1, max_size=40))
def test_clip_and_scale_match_python(spark, rows):
    df = spark.createDataFrame(rows, "x double, a double, b double")
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    out = df.select(
        X.clip("x", -1.0, 0.4).alias("c"),
        X.min_max_scale(F.col("x"), lo, hi, 3.0, 8.0).alias("g"),
    ).collect()
    for (x, a, b), r in zip(rows, out):
        assert r["c"] == py_clip(x, -1.0, 0.4)
        mn, mx = min(a, b), max(a, b)
        if x is None or mx == mn:
            assert r["g"] is None
        else:
            assert r["g"] == pytest.approx(3.0 + 5.0 * (x - mn) / (mx - mn))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-10**6, max_value=10**7)), min_size=1, max_size=40))
def test_clock_text_matches_python(spark, secs):
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    got = [r[0] for r in df.select(X.seconds_to_clock("s")).collect()]
    for s, g in zip(secs, got):
        if s is None:
            assert g is None
        else:
            h, m, sec = (s // 3600) % 24, (s // 60) % 60, s % 60
            assert g == f"{h:02d}:{m:02d}:{sec:02d}"


@pytest.fixture(scope="module")
def graded(spark):
    t = tables_for(spark, SF_CHECK)
    return R.graded_tickets_full(t, Period.of("1996-01-01", "2000-06-30"))


def test_grade_bounds(graded):
    r = graded.agg(
        F.min("delta_tempo_solucao_normalized").alias("gmin"),
        F.max("delta_tempo_solucao_normalized").alias("gmax"),
        F.min("bonus").alias("bmin"),
        F.max("bonus").alias("bmax"),
        F.min("delta_tempo_solucao").alias("dmin"),
        F.max("delta_tempo_solucao").alias("dmax"),
    ).first()
    assert 3.0 - 1e-9 <= r["gmin"] <= r["gmax"] <= 8.0 + 1e-9
    assert 0.8 - 1e-9 <= r["bmin"] <= r["bmax"] <= 1.2 + 1e-9
    assert -1.0 <= r["dmin"] <= r["dmax"] <= 0.4


def test_summary_counts_not_above_detail(spark, graded):
    t = tables_for(spark, SF_CHECK)
    summary = R.technician_month_summary(t, Period.of("1996-01-01", "2000-06-30"), labels=False)
    detail_rows = graded.filter(F.col("nome_tecnico").isNotNull()).count()
    totals = summary.agg(F.sum("id").alias("tickets"), F.sum("Total de atrasos").alias("late")).first()
    assert totals["late"] <= totals["tickets"] <= detail_rows


def test_account_totals_grow_with_largest_id(spark):
    t = tables_for(spark, SF_CHECK)
    rows = R.account_growth_report(t).collect()
    acc = t.accounts.filter("is_active = 1 AND is_deleted = 0 AND date_creation IS NOT NULL")
    max_id = {r["d"]: r["m"] for r in acc.groupBy(F.to_date("date_creation").alias("d")).agg(F.max("id").alias("m")).collect()}
    ordered = sorted(rows, key=lambda r: max_id[r["data"]])
    totals = [r["total_contas"] for r in ordered]
    assert totals == sorted(totals)
    assert all(r["novas_contas"] <= r["total_contas"] for r in rows)
    assert not any(math.isnan(x) for x in totals)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31)), min_size=1, max_size=30))
def test_period_columns_match_python(spark, days):
    from deskmetrics.functions import period as P

    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    rows = df.select(
        P.baseline_first_col(d).alias("bf"),
        P.baseline_last_col(d).alias("bl"),
        P.default_initial_col(d).alias("di"),
        P.default_final_col(d).alias("df"),
        P.annual_initial_col(d).alias("ai"),
        P.month_end_col(d).alias("me"),
    ).collect()
    for day, r in zip(days, rows):
        base = P.Period.of(None, day)
        assert (r["bf"], r["bl"]) == (base.baseline_first, base.baseline_last)
        default = P.default_period(day)
        assert (r["di"], r["df"]) == (default.initial, default.final)
        annual = P.period_for_mode("anual", day)
        assert (r["ai"], r["me"]) == (annual.initial, annual.final)
