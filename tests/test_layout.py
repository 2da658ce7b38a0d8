"""Bucketed layout: same results, and the ticket/bridge and timer/task joins need no shuffle."""

import contextlib
import io
import uuid

import pytest

from conftest import SF_SMALL
from deskmetrics.functions.period import Period
from deskmetrics.operators.worklog import worklog_grouped
from deskmetrics.plans import reports as R
from deskmetrics.session import fresh_path
from deskmetrics.sources.layout import CatalogSource, write_layout
from deskmetrics.sources.tables import Tables

PERIOD = Period.of("1996-01-01", "2000-06-30")
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.deskmetrics.broadcast.maxRows": "0",
}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def layout(spark):
    fixtures = Tables.fixtures(spark, SF_SMALL)
    db = f"desk_{uuid.uuid4().hex[:8]}"
    write_layout(fixtures, db, fresh_path(spark, "layout"), num_buckets=4)
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield fixtures, Tables(spark, CatalogSource(db))
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reports_equal_on_the_layout(layout):
    fixtures, bucketed = layout
    assert same_rows(R.assigned_tickets(fixtures, PERIOD), R.assigned_tickets(bucketed, PERIOD))
    assert same_rows(R.worklog_report(fixtures, PERIOD), R.worklog_report(bucketed, PERIOD))


def test_ticket_bridge_join_without_shuffle_of_tickets(layout, spark):
    _, bucketed = layout
    from deskmetrics.operators.enrich import join_assignee

    t = bucketed.tickets.filter("status IN (5, 6)")
    join = lambda: plan(join_assignee(t, bucketed.tickets_users, bucketed.users, "tickets_id", hot=()))
    p = join()
    # Tickets stay in their buckets; the narrow bridge rows go by user for their names, and back by item.
    assert "hashpartitioning(id#" not in p and p.count("Exchange hashpartitioning(") == 3
    assert "SortMergeJoin" in p
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # users that Spark may broadcast leave the bridge in its buckets, too
    try:
        assert "Exchange hashpartitioning(" not in join()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_timer_task_join_without_shuffle(layout):
    _, bucketed = layout
    p = plan(worklog_grouped(bucketed, PERIOD.initial, PERIOD.final))
    assert "hashpartitioning(tasks_id" not in p and "hashpartitioning(__task" not in p
