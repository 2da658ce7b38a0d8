"""The shared folder: what is refused on a cluster, and what is left over after a run."""

import os

import pytest

from conftest import SF_SMALL
from deskmetrics import session as S
from deskmetrics.plans import reports as R
from deskmetrics.plans.catalog import PERIOD, tables_for


@pytest.mark.parametrize(
    "base,fs,own",
    [
        ("/tmp", "file:///", True), ("/tmp/x/y", "file:///", True), ("file:///var/tmp/a", "hdfs://n", True), ("file:/tmp/../tmp/a", "file:///", True),
        ("/mnt/shared", "file:///", False), ("/tmpfiles", "file:///", False), ("/tmp/x", "hdfs://n:8020", False), ("s3a://bucket/tmp", "file:///", False),
        ("hdfs:///tmp/x", "file:///", False),
    ],
)
def test_machine_local_folders(base, fs, own):
    assert S._machine_local(base, fs) == own


def left(spark):
    return set(os.listdir(S.shared_dir(spark).removeprefix("file:")))


def test_nothing_is_left_after_a_written_report(spark):
    t = tables_for(spark, SF_SMALL)
    R.graded_tickets(t, PERIOD)  # outside of a scope its copies stay, for the result is lazy
    before = left(spark)
    out = f"{S.shared_dir(spark)}/out-{os.getpid()}"
    with S.scratch(spark):
        R.graded_tickets(t, PERIOD).write.parquet(out)
        assert len(left(spark) - before) > 1
    assert left(spark) - before == {os.path.basename(out)}
    assert spark.read.parquet(out).count() == R.assigned_tickets(t, PERIOD).count()


def test_a_run_leaves_its_reports_only(spark):
    t = tables_for(spark, SF_SMALL)
    before = left(spark)
    out = f"{S.shared_dir(spark)}/run-{os.getpid()}"
    R.run_all(t, out, period=PERIOD, reports=["tickets", "worklog", "ticket_summary"])
    assert left(spark) - before == {os.path.basename(out)}


def test_scopes_nest_and_end_on_errors(spark):
    before = left(spark)
    with pytest.raises(ZeroDivisionError):
        with S.scratch(spark):
            outer = S.materialize(spark.range(3))
            with S.scratch(spark):
                S.materialize(spark.range(4))
            assert outer.count() == 3 and len(left(spark) - before) == 1
            1 / 0
    assert left(spark) == before and not S._OPEN
