"""Scalar expressions (X01-X18) as ``Column -> Column`` functions.

All of them are built-in Spark functions, so they stay inside whole-stage codegen.
Division uses ``try_divide``: a zero denominator gives null instead of an ANSI error or
the infinities/NaN a float division would produce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TYPE_LABELS, WORKLOG_OUTLIER_SECONDS

SECONDS_PER_DAY = 86400.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_to_days(c: Column | str) -> Column:
    """X01."""
    return _col(c) / F.lit(SECONDS_PER_DAY)


def seconds_to_clock(c: Column | str) -> Column:
    """Whole seconds as ``HH:MM:SS`` of the day they fall in (wraps at 24 h).

    Plain integer arithmetic, so the session time zone cannot shift it. Null stays null.
    """
    s = _col(c).cast("bigint")
    hours = F.pmod(F.floor(s / 3600), F.lit(24))
    minutes = F.pmod(F.floor(s / 60), F.lit(60))
    seconds = F.pmod(s, F.lit(60))
    text = F.format_string("%02d:%02d:%02d", hours, minutes, seconds)
    return F.when(s.isNotNull(), text)


def type_label(c: Column | str = "type") -> Column:
    """Type code to its label; other codes shown as their number."""
    code = _col(c)
    expr = None
    for key, label in TYPE_LABELS.items():
        expr = (F.when(code == key, F.lit(label)) if expr is None else expr.when(code == key, F.lit(label)))
    return expr.otherwise(code.cast("string"))


def late_flag(solved: Column | str = "solvedate", due: Column | str = "time_to_resolve") -> Column:
    """Solved after the due time; false when either is missing."""
    return F.coalesce(_col(solved) > _col(due), F.lit(False))


def month_key(c: Column | str) -> Column:
    """X05 + X07: ``yyyy-MM`` of a date or timestamp."""
    return F.date_format(_col(c), "yyyy-MM")


def truncate_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column becomes its calendar date (nulls kept), order kept."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.to_date(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def clip(c: Column | str, lower: float, upper: float) -> Column:
    """Clip into ``[lower, upper]``; null stays null."""
    x = _col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(lower))), F.lit(float(upper))))


def min_max_scale(x: Column, lo: Column, hi: Column, min_grade: float, max_grade: float) -> Column:
    """Map ``x`` from ``[lo, hi]`` onto ``[min_grade, max_grade]``; null when lo == hi."""
    span = float(max_grade) - float(min_grade)
    return F.lit(float(min_grade)) + F.lit(span) * F.try_divide(x - lo, hi - lo)


def safe_ratio(num: Column, den: Column) -> Column:
    """X11: ``num / den``, null for a zero denominator."""
    return F.try_divide(num, den)


def volume_bonus(n: Column, lo: Column, hi: Column, coef: float) -> Column:
    """``(1-c) + 2c * (n-lo)/(hi-lo)``, i.e. 1-c for the quietest, 1+c for the busiest."""
    return F.lit(1.0 - coef) + F.lit(2.0 * coef) * F.try_divide(n - lo, hi - lo)


def final_grade(grade: Column, bonus: Column, weight: Column, coef: float) -> Column:
    """Grade times volume bonus times difficulty factor ``1 + (weight-3)*coef``."""
    return grade * bonus * (F.lit(1.0) + (weight - F.lit(3)) * F.lit(float(coef)))


def reset_outlier(c: Column | str, limit: int = WORKLOG_OUTLIER_SECONDS) -> Column:
    """Totals above ``limit`` seconds become 0; null stays null."""
    x = _col(c)
    return F.when(x > limit, F.lit(0)).otherwise(x)


def elected_time(timer: Column | str, manual: Column | str) -> Column:
    """Timer total, or the manual total when the timer is null or 0."""
    return F.coalesce(F.nullif(_col(timer), F.lit(0)), _col(manual))


def round_half_even(c: Column | str, digits: int) -> Column:
    """X17."""
    return F.bround(_col(c), digits)
