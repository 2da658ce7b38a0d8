"""The Bloom filter of a window's ids: nothing is lost, bridges shrink before their exchanges."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from test_plans import plan
from deskmetrics.operators.enrich import bridge_rows
from deskmetrics.operators.joins import MAX_ROWS_CONF
from deskmetrics.operators.prefilter import IDS_PER_WORD, MAX_IDS_CONF, bloom_filter, id_filter
from deskmetrics.plans import reports as R
from deskmetrics.plans.catalog import PERIOD, tables_for
from deskmetrics.schemas import ROLE_ASSIGNED


@pytest.mark.parametrize("n", [0, 1, 300, 20_000])
def test_no_id_is_lost_and_few_others_pass(spark, n):
    ids = spark.range(n).select((F.col("id") * 7_919 - 50_000).alias("k"))
    keep = bloom_filter(ids, n)
    assert keep.words >= n / IDS_PER_WORD and keep.words <= max(64, 2 * n / IDS_PER_WORD)
    assert ids.filter(keep.may_contain(F.col("k"))).count() == n
    # The same ids in another integer type hash alike.
    assert ids.filter(F.abs("k") < 2**31).filter(keep.may_contain(F.col("k").cast("int"))).count() == ids.filter(F.abs("k") < 2**31).count()
    others = spark.range(200_000).select((F.col("id") * 7_919 - 49_999).alias("k"))
    assert others.filter(keep.may_contain(F.col("k"))).count() < 200_000 * 0.02
    assert spark.range(5).filter(keep.may_contain(F.lit(None).cast("long"))).count() == 0


@pytest.mark.parametrize("make", [bloom_filter, id_filter])
def test_keys_of_two_columns(spark, make):
    ids = spark.range(500).select((F.col("id") % 3).alias("kind"), "id")
    keep = make(ids, 500)
    assert (keep.bits is None) == (make is id_filter)
    rows = ids.unionByName(ids.limit(0)).unionByName(ids.select(F.lit(None).cast("long").alias("kind"), "id"))
    assert keep.cut(rows, F.col("kind"), F.col("id")).count() == 500
    other = ids.select(((F.col("kind") + 1) % 3).alias("kind"), "id")
    assert keep.cut(other, F.col("kind"), F.col("id")).count() < 25


def test_no_filter_that_is_not_worth_it(spark):
    ids = spark.range(1000)
    assert id_filter(ids, 1000, 3999) is None
    assert id_filter(ids, 1000, 4000).bits is None
    assert id_filter(ids, 1_000_000, 4_000_000).bits is not None


def test_no_filter_beyond_the_limit(spark):
    ids = spark.range(10)
    assert id_filter(ids, 10**9) is None
    spark.conf.set(MAX_IDS_CONF, "0")
    try:
        assert id_filter(ids, 1) is None
        t = tables_for(spark, SF_SMALL)
        without = R.observed_tickets(t, PERIOD)
        assert "__keep" not in plan(without) and "element_at" not in plan(without)
        rows = without.count()
    finally:
        spark.conf.unset(MAX_IDS_CONF)
    assert R.observed_tickets(t, PERIOD).count() == rows


@pytest.mark.parametrize("most", [None, "0"], ids=["ids", "bloom"])
@pytest.mark.parametrize("name,report", [("tickets", "assigned"), ("changes", "changes"), ("problems", "problems")])
def test_bridge_rows_are_cut_before_their_exchanges(spark, name, report, most):
    """Of all bridge rows, only those of the window's items (and with Bloom filters a few by chance) reach an exchange."""
    if most is not None:
        spark.conf.set(MAX_ROWS_CONF, most)
    try:
        t = tables_for(spark, SF_SMALL)
        lk = R.lookups_for(t, PERIOD, name)
        ids = R._window_ids(t, name, PERIOD)
        assert lk.rows[name] == ids.count()
        keep = id_filter(ids, lk.rows[name])
        bridge, item = R.BRIDGES[name]
        every = bridge_rows(getattr(t, bridge), item, ROLE_ASSIGNED)
        cut = bridge_rows(getattr(t, bridge), item, ROLE_ASSIGNED, keep)
        needed = every.join(ids, every["__item"] == ids["id"], "left_semi").count()
        assert needed <= cut.count() <= needed + (0 if most is None else 0.05 * every.count()) < 0.6 * every.count()
        df = {"assigned": R.assigned_tickets, "changes": R.changes_report, "problems": R.problems_report}[report](t, PERIOD)
        p = plan(df, "simple")
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
    # From each scan of the bridge upwards, the cut comes before the first exchange.
    lines = p.splitlines()
    starts = [i for i, line in enumerate(lines) if "FileScan" in line and "l_linenumber" in line]
    assert starts
    for i in starts:
        above = next(j for j in range(i, 0, -1) if "Exchange hashpartitioning(" in lines[j] and lines[j].index("Exchange") < lines[i].index("FileScan"))
        assert any(("LeftSemi" if most is None else "element_at(Subquery") in line for line in lines[above:i])


def test_combined_report_has_one_set_of_lookups(spark):
    """One fan-out and one pass over each lookup for tickets, changes and problems together, with shuffle joins only."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.deskmetrics.broadcast.maxRows": "0"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        t = tables_for(spark, SF_SMALL)
        together = plan(R.combined_report(t, PERIOD), "simple")
        apart = [plan(df, "simple") for df in (R.tickets_for_combining(t, PERIOD), R.changes_report(t, PERIOD), R.problems_report(t, PERIOD))]
    finally:
        for k in off:
            spark.conf.unset(k)
    outside = lambda p: [line for line in p.splitlines() if "Subquery" not in line]
    joins = lambda p, key: sum("SortMergeJoin" in line and key in line for line in outside(p))
    for key in ("__user", "itilcategories_id", "__fk0___item"):
        assert joins(together, key) == sum(joins(p, key) for p in apart) / 3 > 0
    keyed = lambda p: sum("hashpartitioning(" in line and any(k in line for k in ("__user", "__item", "itilcategories_id", "__key_")) for line in outside(p))
    assert keyed(together) <= sum(keyed(p) for p in apart) / 3
