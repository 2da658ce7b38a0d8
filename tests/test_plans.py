"""Plan shape: no quadratic joins, no Python in the plans, filters and pruning at the scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# The optional training-data queries have tests of their own.
QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_quadratic_join(spark, name):
    if name in ("sink_report", "sink_snapshot", "run_all"):
        pytest.skip("plans over written files")
    p = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad} in plan"


def test_period_filter_reaches_the_scan(spark):
    p = plan(QUERIES["filter_period"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in p
    assert "LessThan(o_orderdate,2000-07-01T00:00)" in p


def test_columns_pruned_at_the_scan(spark):
    p = plan(QUERIES["worklog_detail"](spark, SF_SMALL))
    lineitem_scans = [line for line in p.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert lineitem_scans
    for line in lineitem_scans:
        for unused in ("l_partkey", "l_discount", "l_tax", "l_linestatus"):
            assert unused not in line


def test_month_table_is_broadcast(spark):
    p = plan(QUERIES["technician_month_summary"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "Window" not in p.split("== Physical Plan ==")[-1] or "RunningWindowFunction" not in p


def test_category_baseline_scans_tickets_once(spark):
    p = plan(QUERIES["category_baseline"](spark, SF_SMALL))
    locations = [line for line in p.splitlines() if line.startswith("Location:")]
    assert sum("orders.parquet" in line for line in locations) == 1


def test_summary_aggregates_after_partial_combine(spark):
    """Each aggregation level shuffles on its own full key, after a map-side partial
    aggregate; no level rides on the (month, technician) join shuffle."""
    p = plan(QUERIES["technician_month_summary"](spark, SF_SMALL))
    assert "hashpartitioning(nome_tecnico" in p
    per_ticket = [l for l in p.splitlines() if "hashpartitioning(nome_tecnico" in l and "id#" in l]
    assert per_ticket, "per-ticket level must shuffle on (technician, month, ticket)"


def test_account_growth_orders_only_one_row_for_each_day_and_step(spark):
    """The only window is the running sum over the steps; no join, and nothing in id order."""
    p = plan(QUERIES["account_growth"](spark, SF_SMALL))
    windows = [line for line in p.splitlines() if line.startswith("Arguments:") and "windowspecdefinition" in line]
    assert len(windows) == 1 and "step" in windows[0]
    assert "rangepartitioning" not in p


def stages(spark):
    """The plans of the reports up to their copies, which an explained report no longer shows."""
    from deskmetrics.operators import enrich
    from deskmetrics.operators.accounts import eligible_accounts
    from deskmetrics.plans import reports as R
    from deskmetrics.plans.catalog import PERIOD, tables_for

    t = tables_for(spark, SF_SMALL)
    pairs = enrich.observer_pairs(t.tickets, t, PERIOD.baseline_first, PERIOD.final)
    return {
        "assigned": R.assigned_tickets(t, PERIOD),
        "derived": R.derived_tickets(t, PERIOD, R.ScoreConfig(), False, R._grading_columns(R.ScoreConfig())),
        "pairs": pairs,
        "observed": R.observer_rows(t, PERIOD),
        "changes": R.changes_report(t, PERIOD),
        "accounts": eligible_accounts(t.accounts),
    }


@pytest.mark.parametrize("name", ["assigned", "derived", "pairs", "observed", "changes", "accounts"])
def test_stages_have_no_python_and_no_quadratic_join(spark, name):
    p = plan(stages(spark)[name])
    assert "Scan parquet" in p
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad} in plan"


def scans(p, table):
    """(pushed filters, columns) of every scan of a table in a formatted plan."""
    found = []
    for block in p.split("\n\n"):
        if f"{table}.parquet" in block and "ReadSchema" in block:
            lines = {line.split(":")[0]: line for line in block.splitlines() if ":" in line}
            found.append((lines.get("PushedFilters", ""), lines["ReadSchema"]))
    return found


def test_assigned_tickets_filter_each_scan_of_tickets(spark):
    """Once for the rows, once for the category means, once for the ids that cut the bridge, all with the window pushed down."""
    own = scans(plan(stages(spark)["assigned"]), "orders")
    windowed = [r for f, r in own if "GreaterThanOrEqual(o_orderdate" in f and "LessThan(o_orderdate" in f]
    assert len(windowed) == 3 and sum("o_totalprice" not in r for r in windowed) == 1
    assert len(own) == len(windowed) + sum("o_custkey" not in r and "o_orderpriority" in r for _, r in own)


def test_derived_stage_reads_only_what_grading_needs(spark):
    df = stages(spark)["derived"]
    assert set(df.columns) == {"id", "date", "nome_tecnico", "peso", "atraso", "tempo_solucao", "tempo_medio_solucao", "__close_secs", "__solve_secs"}
    for _, read in scans(plan(df), "lineitem"):
        assert "l_shipdate" not in read and "l_extendedprice" not in read


def test_worklog_prunes_timers_and_tasks(spark):
    from deskmetrics.plans.catalog import tables_for

    t = tables_for(spark, SF_SMALL)
    for df, unused in ((t.timers.select("tasks_id", "actual_end"), "l_extendedprice"), (t.tasks.select("id", "tickets_id"), "l_quantity")):
        assert all(unused not in read for _, read in scans(plan(df), "lineitem"))


@pytest.mark.parametrize("name", ["sink_report", "sink_snapshot", "run_all"])
def test_sinks_read_back_what_they_wrote(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "Scan" in p and "PythonUDF" not in p and "EvalPython" not in p
