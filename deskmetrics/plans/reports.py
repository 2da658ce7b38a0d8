"""The user-facing reports (R01-R11), each one lazy DataFrame plan from scan to result.

Building a report runs two kinds of jobs only:
* size checks (the dimension tables, the window's items, the grading lookup; once for each ``Tables``, a bridge's hot items);
* parquet copies, in the shared folder, of small or twice-read intermediate results (the derived ticket
  rows, with the columns the report needs, the per-(month, technician) lookup in
  grading, the worklog's groups).

The parts before a copy are functions of their own (``derived_tickets``, ``with_assignees``,
``observer_rows``), so their plans can be looked at.
The rest runs when the caller sends the result somewhere (a sink, ``collect`` of a
summary, ...).
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.period import Period
from ..functions.predicates import finished, in_dates, not_excluded
from ..operators import accounts as A
from ..operators import enrich as E
from ..operators import scoring as S
from ..operators import worklog as W
from ..operators.joins import FanOut, fan_out, hot_test, keep_columns, left_lookup
from ..operators.prefilter import IdFilter, id_filter
from ..schemas import CHANGE_TAG, COMMON_COLUMNS, DETAIL_COLUMNS, PROBLEM_TAG, ROLE_ASSIGNED, ROLE_OBSERVER, SUMMARY_LABELS
from ..session import materialize as _materialize
from ..session import scratch
from ..sources.tables import Tables

ScoreConfig = S.ScoreConfig


def _in_period(df: DataFrame, period: Period) -> DataFrame:
    return df.filter(in_dates("date", period.initial, period.final) & finished("status"))


def _month_bound(period: Period) -> int | None:
    if period.initial is None or period.final is None:
        return None
    return period.month_count()


# -- tickets ------------------------------------------------------------------


#: Item table -> its bridge and the bridge's item column.
BRIDGES = {
    "tickets": ("tickets_users", "tickets_id"),
    "changes": ("changes_users", "changes_id"),
    "problems": ("problems_users", "problems_id"),
}


NAMES_AND_WEIGHTS = ("categories", "category_weights")


def _window_ids(tables: Tables, name: str, period: Period) -> DataFrame:
    return _in_period(getattr(tables, name), period).select("id")


def lookups_for(tables: Tables, period: Period, *names: str, needed: Sequence[str] = E.DIMENSIONS) -> E.Lookups:
    """The ``needed`` dimension tables, checked, and the rows of the report's windows, in one small job."""
    return E.Lookups.of(tables, windows={name: _window_ids(tables, name, period) for name in names or ("tickets",)}, needed=needed)


def _keep(tables: Tables, name: str, period: Period, lk: E.Lookups) -> IdFilter | None:
    """The filter of the window's items for their bridge; none for a period without bounds."""
    if period.initial is None and period.final is None:
        return None
    ids = _window_ids(tables, name, period)
    return id_filter(ids, lk.rows[name] if name in lk.rows else ids.count(), E.hot_items(tables, *BRIDGES[name]).rows)


def with_assignees(tables: Tables, period: Period, columns: Sequence[str] | None = None, lk: E.Lookups | None = None) -> DataFrame:
    """Finished tickets of the period (all columns, or ``columns``), one row per assignee first name."""
    return _with_staff(tables, "tickets", period, columns, lk)


def _with_staff(
    tables: Tables, name: str, period: Period, columns: Sequence[str] | None, lk: E.Lookups | None, keep_user: bool = False
) -> DataFrame:
    base = _in_period(getattr(tables, name), period)
    if columns:
        base = base.select(*columns)
    keep = _keep(tables, name, period, lk or lookups_for(tables, period, name, needed=()))
    bridge, item_col = BRIDGES[name]
    staff = E.assignees(getattr(tables, bridge), tables.users, item_col, keep=keep)
    out = fan_out(base, ["id"], [staff], hot_test(E.hot_items(tables, bridge, item_col).keys))
    return out if keep_user else out.drop("__user")


def assigned_tickets(tables: Tables, period: Period, lk: E.Lookups | None = None, stages: "Stages | None" = None) -> DataFrame:
    """SQL part of R01: finished tickets of the period with category, weight, origin,
    assignee first name (one row per assignee) and the previous year's category means
    in seconds. The assignee fan-out runs on the bare tickets; the lookups follow."""
    lk = lk or (stages.lookups if stages else lookups_for(tables, period))
    t = stages.assigned.drop("__user") if stages else with_assignees(tables, period, lk=lk)
    t = E.join_category(t, lk)
    t = E.join_category_weight(t, lk)
    t = E.join_request_type(t, lk)
    days = stages.days if stages else None
    baseline = E.category_baseline(tables.tickets, lk, period.baseline_first, period.baseline_last, days=days)
    t = E.join_category_baseline(t, baseline, lk)
    added = ["nome_categoria", "peso", "origem", "nome_tecnico", "tempo_medio_fechamento", "tempo_medio_solucao"]
    return t.select(*tables.tickets.columns, *added)


class Stages:
    """What several reports of one run share, each written once when the first of them asks for it.

    ``assigned``: finished tickets of the period per assignee, every column and the user's id, the only read of tickets and assignees;
    ``days``: the category sums per day, which the means of either window fold; ``graded``: the graded ticket rows.
    Reports may ask from several threads."""

    def __init__(self, tables: Tables, period: Period, config: ScoreConfig | None = None):
        self.tables, self.period, self.config = tables, period, config or ScoreConfig()
        self._lock, self._made = threading.RLock(), {}

    def _once(self, name: str, make):
        with self._lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    @property
    def lookups(self) -> E.Lookups:
        return self._once("lookups", lambda: lookups_for(self.tables, self.period))

    @property
    def assigned(self) -> DataFrame:
        return self._once("assigned", lambda: _materialize(_with_staff(self.tables, "tickets", self.period, None, self.lookups, keep_user=True)))

    @property
    def days(self) -> DataFrame:
        first, last = self.period.baseline_first, self.period.final
        return self._once("days", lambda: _materialize(E.category_days(self.tables.tickets, first, last)))

    @property
    def graded(self) -> DataFrame:
        return self._once("graded", lambda: _graded(self.tables, self.period, self.config, stages=self))


def _grading_columns(config: ScoreConfig) -> list[str]:
    """What grading and the summary read of the derived rows."""
    per_metric = [c for m, _ in config.metrics() for c in (f"tempo_{m}", f"tempo_medio_{m}")]
    return ["id", "date", "nome_tecnico", "peso", "atraso", *per_metric, "__close_secs", "__solve_secs"]


def derived_tickets(
    tables: Tables,
    period: Period,
    config: ScoreConfig,
    clock_text: bool = True,
    columns: Sequence[str] | None = None,
    lk: E.Lookups | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Derived ticket rows before grading; ``columns`` keeps only those."""
    derived = S.derive_ticket_columns(assigned_tickets(tables, period, lk, stages), config.exclude_technicians, clock_text)
    return derived if columns is None else derived.select(*[c for c in derived.columns if c in set(columns)])


def _graded(
    tables: Tables,
    period: Period,
    config: ScoreConfig,
    clock_text: bool = True,
    columns: Sequence[str] | None = None,
    lk: E.Lookups | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Derived ticket rows, graded. The derived rows feed two branches (the rows themselves
    and the per-(month, technician) aggregate), so they are written once, pruned to what is needed."""
    derived = _materialize(derived_tickets(tables, period, config, clock_text, columns, lk, stages))
    return S.grade_tickets(derived, config, _month_bound(period))


def ticket_snapshot(tables: Tables, period: Period, config: ScoreConfig | None = None) -> DataFrame:
    """S14 for tickets: the rows after the derived columns (X01-X06, F07), before grading;
    write it with ``sinks.write_snapshot``. Worklog and change/problem snapshots are the
    ``worklog_report`` and ``changes_report``/``problems_report`` stages themselves."""
    return S.drop_hidden(derived_tickets(tables, period, config or ScoreConfig()))


def graded_tickets_full(
    tables: Tables, period: Period, config: ScoreConfig | None = None, clock_text: bool = True, lk: E.Lookups | None = None
) -> DataFrame:
    """R01 with every column (the original with ``relatorio_limpo=False``)."""
    return S.drop_hidden(_graded(tables, period, config or ScoreConfig(), clock_text, lk=lk))


def graded_tickets(
    tables: Tables, period: Period, config: ScoreConfig | None = None, clock_text: bool = True
) -> DataFrame:
    """Graded ticket detail, detail allow-list (C03). ``clock_text=False`` keeps the
    delay columns as whole seconds instead of ``HH:MM:SS`` text."""
    config = config or ScoreConfig()
    columns = [*DETAIL_COLUMNS, *_grading_columns(config)]
    return keep_columns(S.drop_hidden(_graded(tables, period, config, clock_text, columns)), DETAIL_COLUMNS)


def technician_month_summary(
    tables: Tables, period: Period, config: ScoreConfig | None = None, labels: bool = True, stages: Stages | None = None
) -> DataFrame:
    """R02."""
    config = config or ScoreConfig()
    return S.technician_summary(_graded(tables, period, config, False, _grading_columns(config), stages=stages), config, labels)


def in_key_order(summary: DataFrame) -> DataFrame:
    """A summary (one row per technician and month, a bounded table) sorted by its first two columns."""
    return summary.orderBy(*[F.col(f"`{c}`") for c in summary.columns[:2]])


#: Rows that one piece of an ordered result should have.
ORDERED_ROWS = 100_000


def with_position(summary: DataFrame, name: str = "posicao") -> DataFrame:
    """O01 as a column: each row's place (from 1) in key order, so that the order survives formats that keep none.

    The rows are range-partitioned by key and written with the number of their piece; a row's place is its place in the
    piece after the rows of the pieces before. Only one number per piece meets in one task."""
    keys = [F.col(f"`{c}`") for c in summary.columns[:2]]
    summary = _materialize(summary)
    pieces = -(-summary.count() // ORDERED_ROWS) or 1
    # Written: the bounds of a range partitioning are sampled, and both readers must see the same pieces.
    dealt = _materialize(summary.repartitionByRange(pieces, *keys).withColumn("__piece", F.spark_partition_id()))
    before = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # one row per piece
    sizes = dealt.groupBy(F.col("__piece").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__piece").orderBy(*keys))
    out = dealt.withColumn("__place", place).join(F.broadcast(sizes), F.col("__piece") == F.col("__of"), "inner")
    return out.select(*[F.col(f"`{c}`") for c in summary.columns], (F.col("__before") + F.col("__place")).cast("bigint").alias(name))


def tickets_for_combining(
    tables: Tables, period: Period, config: ScoreConfig | None = None, lk: E.Lookups | None = None
) -> DataFrame:
    """The graded tickets restricted to the columns shared with changes/problems.

    None of the kept columns comes from grading, and grading only adds columns (its
    joins are left joins on keys that are unique on the right), so the rows and kept
    values equal those of the derived tickets: grading is skipped. So are the lookups of
    origin and category means, which add columns only, too. Catalyst cannot prove that uniqueness."""
    config = config or ScoreConfig()
    lk = lk or lookups_for(tables, period, needed=NAMES_AND_WEIGHTS)
    t = E.join_category_weight(E.join_category(with_assignees(tables, period, lk=lk), lk), lk)
    for name in ("tempo_medio_fechamento", "tempo_medio_solucao"):
        t = t.withColumn(name, F.lit(None).cast("double"))
    derived = S.derive_ticket_columns(t, config.exclude_technicians)
    kept = ["nome_categoria", "peso", "nome_tecnico"]  # in the order of the full report
    derived = derived.select(*[c for c in derived.columns if c not in kept], *kept)
    return keep_columns(derived, COMMON_COLUMNS)


class TicketReport:
    """One graded ticket set with its several outputs, graded (and checkpointed) once.

    ``full()`` keeps every column, ``detail()`` the detail allow-list, ``summary()`` the
    technician-month summary, ``common()`` the columns shared with changes/problems and
    ``snapshot()`` the rows before grading. Asking for several of them reads the same
    checkpointed rows instead of grading again.
    """

    def __init__(self, tables: Tables, period: Period, config: ScoreConfig | None = None, clock_text: bool = True):
        self.tables, self.period = tables, period
        self.config = config or ScoreConfig()
        self.clock_text = clock_text
        self._graded: DataFrame | None = None

    @property
    def graded(self) -> DataFrame:
        if self._graded is None:
            self._graded = _graded(self.tables, self.period, self.config, self.clock_text)
        return self._graded

    def full(self) -> DataFrame:
        return S.drop_hidden(self.graded)

    def detail(self) -> DataFrame:
        return keep_columns(self.full(), DETAIL_COLUMNS)

    def summary(self, labels: bool = True) -> DataFrame:
        return S.technician_summary(self.graded, self.config, labels)

    def common(self) -> DataFrame:
        return keep_columns(self.full(), COMMON_COLUMNS)

    def snapshot(self) -> DataFrame:
        return ticket_snapshot(self.tables, self.period, self.config)


# -- changes and problems ----------------------------------------------------------


def _change_like(tables: Tables, name: str, period: Period, tag: str, lk: E.Lookups | None) -> DataFrame:
    lk = lk or lookups_for(tables, period, name, needed=NAMES_AND_WEIGHTS)
    df = _with_staff(tables, name, period, None, lk)
    df = E.join_category(df, lk)
    df = E.join_category_weight(df, lk)
    df = df.drop("type").withColumn("type", F.lit(tag))
    return keep_columns(df, COMMON_COLUMNS)


def changes_report(tables: Tables, period: Period, lk: E.Lookups | None = None) -> DataFrame:
    """R06 (F01 F03 J09 J01 J05 C02 C03)."""
    return _change_like(tables, "changes", period, CHANGE_TAG, lk)


def problems_report(tables: Tables, period: Period, lk: E.Lookups | None = None) -> DataFrame:
    """R07 (F01 F03 J10 J01 J05 C02 C03)."""
    return _change_like(tables, "problems", period, PROBLEM_TAG, lk)


TAGS = {"changes": CHANGE_TAG, "problems": PROBLEM_TAG}


def _common_form(items: DataFrame, name: str) -> DataFrame:
    """Items of one kind in the combined report's types: delays as text (of tickets as clock time), dates as calendar dates."""
    as_text = X.seconds_to_clock if name == "tickets" else (lambda c: F.col(c).cast("string"))
    delays = {c: as_text(c) for c in ("close_delay_stat", "solve_delay_stat") if c in items.columns}
    label = X.type_label("type") if name == "tickets" else F.lit(TAGS[name])
    out = items if name == "tickets" else items.drop("type")  # a tag comes last, as in the single report
    return keep_columns(X.truncate_timestamps(out.withColumns({**delays, "type": label})), COMMON_COLUMNS)


def tagged_items(tables: Tables, period: Period, names: Sequence[str], lk: E.Lookups, exclude: Sequence[str] = ()) -> DataFrame:
    """Items of several kinds with assignee, category and weight, by one fan-out and one set of lookups.

    Items and bridge rows of all kinds are unions keyed by (kind, id), so they meet in one join. ``exclude`` drops technicians of tickets."""
    kind = {name: F.lit(i).cast("bigint") for i, name in enumerate(names)}
    items, ids, hot, total = None, None, {}, 0
    for name in names:
        window = _in_period(getattr(tables, name), period)
        own = _common_form(window, name).withColumn("__kind", kind[name])
        items = own if items is None else items.unionByName(own, allowMissingColumns=True)
        own = window.select(kind[name].alias("__kind"), "id")
        ids = own if ids is None else ids.unionByName(own)
        found = E.hot_items(tables, *BRIDGES[name])
        total += found.rows
        if found.keys:
            hot[name] = found.keys
    whole = period.initial is None and period.final is None
    keep = None if whole else id_filter(ids, sum(lk.rows[name] for name in names), total)
    staff = None
    for name in names:
        bridge, item_col = BRIDGES[name]
        rows = E.bridge_rows(getattr(tables, bridge), item_col, ROLE_ASSIGNED).select(kind[name].alias("__kind"), "__item", "__user")
        rows = rows if keep is None else keep.cut(rows, F.col("__kind"), F.col("__item"))
        staff = rows if staff is None else staff.unionByName(rows)
    staff = left_lookup(staff, tables.users, "__user", "id", {"firstname": "nome_tecnico"})

    def is_hot(k, item):
        out = F.lit(False)
        for name, found in hot.items():
            out = out | ((k == kind[name]) & item.isin(*found))
        return out

    step = FanOut(staff, ["__kind", "__item"], ["__user", "nome_tecnico"])
    df = fan_out(items, ["__kind", "id"], [step], is_hot if hot else None)
    if exclude and "tickets" in names:
        df = df.filter((F.col("__kind") != kind["tickets"]) | not_excluded("nome_tecnico", exclude))
    df = E.join_category_weight(E.join_category(df, lk), lk)
    added = ["nome_categoria", "peso", "nome_tecnico"]
    return df.select(*[c for c in items.columns if c != "__kind" and c not in added], *added)


def combined_report(
    tables: Tables, period: Period, config: ScoreConfig | None = None, clean_tickets: bool = True
) -> DataFrame:
    """R09 (U01): tickets, changes and problems; by column name, duplicates kept.

    ``clean_tickets=False`` keeps every graded ticket column (as the original batch script
    calls it); change and problem rows then hold nulls in the ticket-only columns."""
    config = config or ScoreConfig()
    needed = NAMES_AND_WEIGHTS if clean_tickets else E.DIMENSIONS
    lk = lookups_for(tables, period, *BRIDGES, needed=needed)  # one size check for all parts
    if clean_tickets:
        return tagged_items(tables, period, tuple(BRIDGES), lk, config.exclude_technicians)
    tickets = graded_tickets_full(tables, period, config, lk=lk)
    others = tagged_items(tables, period, tuple(TAGS), lk)
    return tickets.unionByName(others, allowMissingColumns=True)


# -- worklog --------------------------------------------------------------------


def worklog_report(
    tables: Tables, period: Period, drop_outliers: bool = True, exclude: Sequence[str] = ()
) -> DataFrame:
    """R04."""
    return S.drop_hidden(_worklog(tables, period, drop_outliers, exclude))


def _worklog(tables: Tables, period: Period, drop_outliers: bool, exclude: Sequence[str]) -> DataFrame:
    return W.elect_time(W.worklog_grouped(tables, period.initial, period.final), drop_outliers, exclude)


def worklog_month_summary(
    tables: Tables, period: Period, drop_outliers: bool = True, exclude: Sequence[str] = (), labels: bool = True
) -> DataFrame:
    """R05."""
    return W.worklog_summary(_worklog(tables, period, drop_outliers, exclude), labels)


# -- accounts -------------------------------------------------------------------


def account_growth_report(tables: Tables) -> DataFrame:
    """R08."""
    return A.account_growth(tables.accounts)


# -- observers ------------------------------------------------------------------


def observer_rows(
    tables: Tables, period: Period, columns: Sequence[str] | None = None, lk: E.Lookups | None = None, stages: Stages | None = None
) -> DataFrame:
    """Finished tickets of the period, one row per assignee x eligible observer (null where there is none).

    Both fan-outs are keyed on the ticket: the second one finds the rows of ordinary tickets where the first one has put them.
    Only observers of the report's tickets count, so the filter of its ids cuts their bridge rows, too."""
    lk = lk or lookups_for(tables, period)
    base = stages.assigned if stages else _in_period(tables.tickets, period)
    if columns:
        base = base.select(*columns, *(["__user", "nome_tecnico"] if stages else []))
    keep = _keep(tables, "tickets", period, lk)
    steps = [E.observers(tables, period.baseline_first, period.final, keep)]
    if not stages:
        steps.insert(0, E.assignees(tables.tickets_users, tables.users, "tickets_id", keep=keep))
    hot = [i for role in (ROLE_ASSIGNED, ROLE_OBSERVER) for i in E.hot_items(tables, "tickets_users", "tickets_id", role).keys]
    return fan_out(base, ["id"], steps, hot_test(sorted(set(hot)))).drop("__user")


def observed_tickets(tables: Tables, period: Period, stages: Stages | None = None) -> DataFrame:
    """Finished tickets of the period, one row per assignee x eligible observer.

    The category means and the observers use the window from January 1 of the
    previous year to the final date (A03)."""
    lk = stages.lookups if stages else lookups_for(tables, period, needed=("categories", "request_types"))
    t = observer_rows(tables, period, lk=lk, stages=stages)
    t = E.join_category(t, lk)
    t = E.join_request_type(t, lk)
    days = stages.days if stages else None
    baseline = E.category_baseline(tables.tickets, lk, period.baseline_first, period.final, days=days)
    t = E.join_category_baseline(t, baseline, lk)
    added = ["nome_categoria", "origem", "nome_tecnico", "nome_observador", "tempo_medio_fechamento", "tempo_medio_solucao"]
    return t.select(*tables.tickets.columns, *added)


def _observer_counts(rows: DataFrame, tables: Tables, period: Period, keep: IdFilter | None) -> DataFrame:
    """Per observer first name and opening month, the (ticket, assignee) ``rows`` he or she observes.

    Rows without an observer do not count, so this is an inner join, which AQE may split on either side."""
    pairs = E.eligible_observers(tables, keep)
    in_window = rows.filter(in_dates("date", period.baseline_first, period.final))
    seen = in_window.join(pairs, in_window["id"] == pairs["__item"], "inner")
    return seen.groupBy("nome_observador", F.date_format("date", "yyyy-MM").alias("date2")).agg(F.count("id").alias("id"))


def observer_month_counts(tables: Tables, period: Period) -> DataFrame:
    """A10: rows of the observed report per observer first name and opening month; only ids and dates are joined."""
    lk = lookups_for(tables, period, needed=())
    rows = with_assignees(tables, period, ["id", "date"], lk)
    return _observer_counts(rows, tables, period, _keep(tables, "tickets", period, lk))


def technician_observer_summary(tables: Tables, period: Period, config: ScoreConfig | None = None) -> DataFrame:
    """Technician summary and observer counts side by side, full outer on
    (first name, month). Unlabelled key names ``nome``/``date2``; the observer count is
    ``chamados_observados``. Both halves read the same derived ticket rows, written once."""
    config = config or ScoreConfig()
    lk = lookups_for(tables, period)
    derived = _materialize(derived_tickets(tables, period, config, False, _grading_columns(config), lk))
    summary = S.technician_summary(S.grade_tickets(derived, config, _month_bound(period)), config, labels=False)
    summary = summary.withColumnRenamed("nome_tecnico", "nome")
    # The observed report knows no excluded technicians: with any, its rows are read anew.
    rows = with_assignees(tables, period, ["id", "date"], lk) if config.exclude_technicians else derived
    counts = _observer_counts(rows.select("id", "date"), tables, period, _keep(tables, "tickets", period, lk))
    obs = counts.select(
        F.col("nome_observador").alias("__on"), F.col("date2").alias("__od"), F.col("id").alias("chamados_observados")
    )
    joined = summary.join(
        obs, (summary["nome"] == obs["__on"]) & (summary["date2"] == obs["__od"]), "full"
    )
    rest = [c for c in summary.columns if c not in ("nome", "date2")]
    out = joined.select(
        F.coalesce(summary["nome"], obs["__on"]).alias("nome"),
        F.coalesce(summary["date2"], obs["__od"]).alias("date2"),
        *[summary[c] for c in rest],
        obs["chamados_observados"],
    )
    return out.withColumnsRenamed({k: v for k, v in SUMMARY_LABELS.items() if k in rest})


# -- whole run --------------------------------------------------------------------


def run_all(
    tables: Tables,
    out_root: str,
    mode: str = "geral",
    today=None,
    config: ScoreConfig | None = None,
    parallel: bool = True,
    period: Period | None = None,
    reports: Sequence[str] = ("tickets", "worklog", "accounts"),
) -> DataFrame:
    """The batch job of the original script (tickets, worklog, account growth).

    Each report is written as a CSV report below ``out_root`` by the executors. The three
    reports are independent, so with ``parallel`` they are submitted from a small thread
    pool and run as concurrent Spark jobs sharing the cluster (only plans pass through
    the driver). Row counts are observed while writing (``DataFrame.observe``), so no
    report is read again. ``period`` replaces the mode's window; ``reports`` names any of the keys
    below; those that work on the same tickets share stages that are written once (``Stages``). Summaries are written in key order. Result: one row per report with its row count.
    """
    import datetime as dt
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    from ..functions.period import period_for_mode
    from ..sources.sinks import write_report

    period = period or period_for_mode(mode, today or dt.date.today())
    # Reports on the same tickets share their stages; a single one has no use for copies.
    stages = Stages(tables, period, config) if len({"tickets", "ticket_summary", "observed"} & set(reports)) > 1 else None
    graded = {"tickets", "ticket_summary"} <= set(reports)
    builders = {
        "tickets": lambda: S.drop_hidden(stages.graded if graded else _graded(tables, period, config or ScoreConfig(), stages=stages)),
        "worklog": lambda: worklog_report(tables, period),
        "accounts": lambda: account_growth_report(tables),
        "changes": lambda: changes_report(tables, period),
        "problems": lambda: problems_report(tables, period),
        "combined": lambda: combined_report(tables, period, config),
        "observed": lambda: observed_tickets(tables, period, stages),
        "ticket_summary": lambda: in_key_order(
            S.technician_summary(stages.graded, stages.config) if graded else technician_month_summary(tables, period, config, stages=stages)
        ),
        "worklog_summary": lambda: in_key_order(worklog_month_summary(tables, period)),
        "observer_summary": lambda: in_key_order(technician_observer_summary(tables, period, config)),
    }
    builders = {name: builders[name] for name in reports}

    def run(name: str) -> int:
        # Under the fair scheduler each report has a pool of its own, so a long one does not hold up the others.
        tables.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name if parallel else None)
        seen = Observation(f"rows_{name}")
        df = builders[name]().observe(seen, F.count(F.lit(1)).alias("rows"))
        write_report(df, f"{out_root.rstrip('/')}/{name}")
        return int(seen.get["rows"])

    with scratch(tables.spark):  # the reports are written inside; what they were made from goes
        if parallel:
            with ThreadPoolExecutor(max_workers=len(builders)) as pool:
                counts = dict(zip(builders, pool.map(run, builders)))
        else:
            counts = {name: run(name) for name in builders}
    return tables.spark.createDataFrame(
        [(name, counts[name]) for name in builders], "report string, linhas bigint"
    )
