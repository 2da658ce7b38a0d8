"""The plans a large cluster gets: every join a shuffle join, no broadcast at all.

Results must not depend on which join strategy Spark picks."""

import pytest

import __spark_entry__ as E
from compare import canon, duck
from conftest import SF_SMALL

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.deskmetrics.broadcast.maxRows": "0",
}
KEYS = [
    "technician_month_summary",
    "graded_tickets_two_metrics",
    "worklog_elected",
    "worklog_month_summary",
    "account_growth",
    "combined_report",
    "observed_report",
    "technician_observer_summary",
]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", KEYS)
def test_same_result_without_broadcast(no_broadcast, name):
    from deskmetrics.plans.catalog import _TABLES

    _TABLES.clear()  # fresh lookups, so the size check sees the setting
    df = E.queries()[name](no_broadcast, SF_SMALL)
    got = df.toPandas()
    want = duck(SF_SMALL).execute(E.oracle_sql()[name]).df()
    assert len(got) == len(want)
    assert canon(got) == canon(want)
    if name == "technician_month_summary":
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "Broadcast" not in buf.getvalue()
    _TABLES.clear()
