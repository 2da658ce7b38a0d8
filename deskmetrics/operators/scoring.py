"""Ticket grading: derived columns, monthly grades, volume bonus and the summary.

Per-month figures (min/max of a delta, min/max of a technician's volume) are computed as
aggregates and joined back, not as ``Window.partitionBy(month)``: a window would send a
whole month to a single task, while the aggregates combine partially on the map side and
leave one row per month, a table bounded by the months in the report period.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.predicates import not_excluded
from ..schemas import LATE_TOTAL_LABEL, METRIC_ALIASES, SUMMARY_LABELS
from ..session import materialize
from .joins import bounded_counts, broadcast_by_bound, max_broadcast_rows


@dataclass(frozen=True)
class ScoreConfig:
    """Grading parameters (V02). ``weights`` maps a metric to an integer weight.

    Metrics are ``solucao``/``fechamento`` (aliases ``solve``/``close``); order matters
    for column order only. A weight of 0 leaves a metric out.
    """

    weights: dict = field(default_factory=lambda: {"solucao": 1})
    lower: float = -1.0
    upper: float = 0.4
    min_grade: float = 3.0
    max_grade: float = 8.0
    qty_coef: float = 0.2
    difficulty_coef: float = 0.05
    exclude_technicians: tuple = ()

    def metrics(self) -> list[tuple[str, int]]:
        out = []
        for name, weight in self.weights.items():
            metric = METRIC_ALIASES.get(name, name)
            if metric not in METRIC_ALIASES.values():
                raise ValueError(f"unknown metric {name!r}")
            if isinstance(weight, bool) or int(weight) != weight:
                raise ValueError(f"weight of {name!r} must be an integer, got {weight!r}")
            if weight != 0:
                out.append((metric, int(weight)))
        if sum(w for _, w in out) <= 0:
            raise ValueError("at least one metric needs a positive weight")
        return out


def derive_ticket_columns(df: DataFrame, exclude: Sequence[str] = (), clock_text: bool = True) -> DataFrame:
    """X01-X06 + F07 on the enriched ticket rows, in the original column order."""
    replaced = {
        "tempo_medio_fechamento": X.seconds_to_days("tempo_medio_fechamento"),
        "tempo_medio_solucao": X.seconds_to_days("tempo_medio_solucao"),
        "type": X.type_label("type"),
    }
    if clock_text:
        replaced["close_delay_stat"] = X.seconds_to_clock("close_delay_stat")
        replaced["solve_delay_stat"] = X.seconds_to_clock("solve_delay_stat")
    cols = [replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns]
    out = df.select(
        *cols,
        X.seconds_to_days("close_delay_stat").alias("tempo_fechamento"),
        X.seconds_to_days("solve_delay_stat").alias("tempo_solucao"),
        X.late_flag("solvedate", "time_to_resolve").alias("atraso"),
        # Exact integer seconds kept (hidden) so summary means can be taken from exact sums.
        df["close_delay_stat"].cast("bigint").alias("__close_secs"),
        df["solve_delay_stat"].cast("bigint").alias("__solve_secs"),
    )
    if exclude:
        out = out.filter(not_excluded("nome_tecnico", exclude))
    return X.truncate_timestamps(out)


def drop_hidden(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def with_deltas(df: DataFrame, config: ScoreConfig) -> DataFrame:
    """Month key ``date2`` and the clipped delta (days) of each weighted metric."""
    delta_cols = [
        X.clip(F.col(f"tempo_medio_{m}") - F.col(f"tempo_{m}"), config.lower, config.upper).alias(f"delta_tempo_{m}")
        for m, _ in config.metrics()
    ]
    return df.select("*", X.month_key("date").alias("date2"), *delta_cols)


def technician_groups(with_delta: DataFrame, config: ScoreConfig) -> DataFrame:
    """W03 and the first level of W01/W02: per (month, technician first name) the detail rows, which are the
    technician's volume (none for the group of null names), and the delta range of each metric."""
    metrics = [m for m, _ in config.metrics()]
    groups = with_delta.groupBy("date2", "nome_tecnico").agg(
        F.count("id").alias("__rows"),
        *[F.max(f"delta_tempo_{m}").alias(f"__max_{m}") for m in metrics],
        *[F.min(f"delta_tempo_{m}").alias(f"__min_{m}") for m in metrics],
    )
    return groups.withColumn("qtde_chamados", F.when(F.col("nome_tecnico").isNotNull(), F.col("__rows")))


def month_ranges(groups: DataFrame, config: ScoreConfig) -> DataFrame:
    """Per month the delta range of each metric and the range of technician volumes."""
    metrics = [m for m, _ in config.metrics()]
    return groups.groupBy("date2").agg(
        *[F.max(f"__max_{m}").alias(f"max_mes_{m}") for m in metrics],
        *[F.min(f"__min_{m}").alias(f"min_mes_{m}") for m in metrics],
        F.min("qtde_chamados").alias("min_qtde_chamados"),
        F.max("qtde_chamados").alias("max_qtde_chamados"),
    )


def grade_tickets(
    df: DataFrame, config: ScoreConfig, month_bound: int | None = None, check_lookup: bool = True
) -> DataFrame:
    """X07-X14 with W01-W04: month grades, weighted grade, volume bonus, final grade.

    One aggregate per (month, technician) yields both the technician's volume and that
    group's delta range; a second, tiny aggregate folds those into the month table
    (delta range, volume range). ``month_bound`` (months in the report period) proves
    the month table small enough to broadcast. Each detail row then picks up its
    (month, technician) entry with one join; rows without a technician match the
    group of null names (null-safe key), which carries no volume. With ``check_lookup``
    that (month, technician) table is checkpointed and counted up to the broadcast limit,
    and broadcast when within it, so the detail rows are not shuffled to meet it.
    """
    metrics = config.metrics()
    total_weight = sum(w for _, w in metrics)
    with_delta = with_deltas(df, config)

    per_tech = technician_groups(with_delta, config)
    month_table = month_ranges(per_tech, config)
    month_table = broadcast_by_bound(month_table.withColumnRenamed("date2", "__month"), month_bound)
    lookup = per_tech.join(month_table, per_tech["date2"] == month_table["__month"], "inner").select(
        F.col("date2").alias("__m"),
        F.col("nome_tecnico").alias("__t"),
        "qtde_chamados",
        *[F.col(f"max_mes_{m}") for m, _ in metrics],
        *[F.col(f"min_mes_{m}") for m, _ in metrics],
        "min_qtde_chamados",
        "max_qtde_chamados",
    )
    if check_lookup:
        # The lookup has one row per (month, technician name): written once, counted up to
        # the broadcast limit, and broadcast when within it, so the detail rows need no
        # shuffle to meet it. Beyond the limit Spark joins it by shuffling both sides.
        lookup = materialize(lookup)
        limit = max_broadcast_rows(lookup)
        if limit > 0 and bounded_counts({"lookup": lookup}, limit)["lookup"]:
            lookup = F.broadcast(lookup)
    joined = with_delta.join(
        lookup,
        (with_delta["date2"] == lookup["__m"]) & with_delta["nome_tecnico"].eqNullSafe(lookup["__t"]),
        "left",
    )

    # Assemble in the original column order.
    metric_cols = []
    grade = None
    for i, (m, w) in enumerate(metrics):
        delta = F.col(f"delta_tempo_{m}")
        lo, hi = F.col(f"min_mes_{m}"), F.col(f"max_mes_{m}")
        norm = X.min_max_scale(delta, lo, hi, config.min_grade, config.max_grade)
        grade = norm * F.lit(w) if grade is None else grade + norm * F.lit(w)
        metric_cols.append(delta.alias(f"delta_tempo_{m}"))
        if i == 0:
            metric_cols.append(F.col("date2"))
        metric_cols += [
            hi.alias(f"max_mes_{m}"),
            lo.alias(f"min_mes_{m}"),
            norm.alias(f"delta_tempo_{m}_normalized"),
            X.safe_ratio(delta, F.col(f"tempo_medio_{m}")).alias(f"diferenca_media_vs_gasto_{m}"),
        ]
    grade = grade / F.lit(float(total_weight))
    bonus = X.volume_bonus(
        F.col("qtde_chamados"), F.col("min_qtde_chamados"), F.col("max_qtde_chamados"), config.qty_coef
    )
    graded = joined.select(
        *[F.col(c) for c in df.columns],
        grade.alias("nota_final_tempos"),
        *metric_cols,
        F.col("qtde_chamados"),
        bonus.alias("bonus"),
    )
    final = X.final_grade(F.col("nota_final_tempos"), F.col("bonus"), F.col("peso"), config.difficulty_coef)
    return graded.withColumn("nota_final", final)


def technician_summary(graded: DataFrame, config: ScoreConfig, labels: bool = True) -> DataFrame:
    """R02 (A08, A09, X17, C04-C06): one row per technician first name and month.

    Tickets are counted once each and late tickets once each, while the means run over
    all detail rows. Two aggregation levels do this without a second distinct count:
    first per (technician, month, ticket), then per (technician, month). Rows with a
    null technician or month are dropped.
    """
    metrics = {m for m, _ in config.metrics()}
    averaged = []
    if "fechamento" in metrics:
        averaged += ["tempo_fechamento", "diferenca_media_vs_gasto_fechamento"]
    if "solucao" in metrics:
        averaged += ["tempo_solucao", "diferenca_media_vs_gasto_solucao"]
    averaged.append("nota_final")

    # Time means from the exact integer seconds when the detail still carries them.
    exact_seconds = {}
    for c, secs in (("tempo_fechamento", "__close_secs"), ("tempo_solucao", "__solve_secs")):
        if c in averaged and secs in graded.columns:
            exact_seconds[c] = secs
    source = {c: exact_seconds.get(c, c) for c in averaged}

    keys = ["nome_tecnico", "date2"]
    per_ticket = (
        graded.filter(F.col("nome_tecnico").isNotNull() & F.col("date2").isNotNull())
        .groupBy(*keys, "id")
        .agg(
            F.max(F.col("atraso").cast("int")).alias("__late"),
            *[F.sum(source[c]).alias(f"__s_{c}") for c in averaged],
            *[F.count(source[c]).alias(f"__n_{c}") for c in averaged],
        )
    )
    means = {}
    for c in averaged:
        mean = F.try_divide(F.sum(f"__s_{c}"), F.sum(f"__n_{c}"))
        if c in exact_seconds:
            mean = mean / F.lit(X.SECONDS_PER_DAY)
        if c == "diferenca_media_vs_gasto_solucao":
            mean = X.round_half_even(mean, 4)
        means[c] = mean.alias(c)
    summary = per_ticket.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("id"),
        F.sum("__late").cast("bigint").alias(LATE_TOTAL_LABEL),
        *[means[c] for c in averaged],
    )
    if labels:
        summary = summary.withColumnsRenamed({k: v for k, v in SUMMARY_LABELS.items() if k in summary.columns})
    return summary
