"""Report periods.

A ``Period`` holds the four dates a report is bound with: the report window
(``initial``..``final``) and the baseline year derived from ``final``. The same rules
are also given as Column expressions so they can run per row (e.g. over a column of
"today" dates) instead of once on the driver.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WHOLE_HISTORY_START

DateLike = dt.date | str


def _as_date(value: DateLike | None) -> dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


@dataclass(frozen=True)
class Period:
    initial: dt.date | None
    final: dt.date | None

    @classmethod
    def of(cls, initial: DateLike | None, final: DateLike | None) -> "Period":
        return cls(_as_date(initial), _as_date(final))

    # Previous calendar year of the final date; absent without a final date.
    @property
    def baseline_first(self) -> dt.date | None:
        return None if self.final is None else dt.date(self.final.year - 1, 1, 1)

    @property
    def baseline_last(self) -> dt.date | None:
        return None if self.final is None else dt.date(self.final.year - 1, 12, 31)

    def month_count(self) -> int:
        """Number of calendar months the window touches (a bound on month keys)."""
        if self.initial is None or self.final is None:
            raise ValueError("an open period has no month bound")
        return (self.final.year - self.initial.year) * 12 + self.final.month - self.initial.month + 1

    def args(self) -> dict[str, dt.date | None]:
        """Named parameters for ``spark.sql(text, args=...)``."""
        return {
            "initial_date": self.initial,
            "final_date": self.final,
            "first_day": self.baseline_first,
            "last_day": self.baseline_last,
        }


def _first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def _last_of_month(d: dt.date) -> dt.date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def default_period(today: DateLike) -> Period:
    """final = first day of this month, initial = 365 days before it."""
    t = _as_date(today)
    final = _first_of_month(t)
    return Period(final - dt.timedelta(days=365), final)


def period_for_mode(mode: str, today: DateLike) -> Period:
    """``geral`` = whole history, ``anual`` = about the last twelve months."""
    t = _as_date(today)
    final = _last_of_month(t)
    if mode == "geral":
        return Period(_as_date(WHOLE_HISTORY_START), final)
    if mode == "anual":
        return Period(_first_of_month(final - dt.timedelta(days=360)), final)
    raise ValueError(f"unknown period mode {mode!r}; use 'anual' or 'geral'")


# -- the same rules as Column expressions -------------------------------------


def baseline_first_col(final: Column) -> Column:
    return F.make_date(F.year(final) - 1, F.lit(1), F.lit(1))


def baseline_last_col(final: Column) -> Column:
    return F.make_date(F.year(final) - 1, F.lit(12), F.lit(31))


def default_final_col(today: Column) -> Column:
    return F.trunc(today, "MM")


def default_initial_col(today: Column) -> Column:
    return F.date_sub(F.trunc(today, "MM"), 365)


def whole_history_initial_col() -> Column:
    return F.to_date(F.lit(WHOLE_HISTORY_START))


def month_end_col(today: Column) -> Column:
    return F.last_day(today)


def annual_initial_col(today: Column) -> Column:
    return F.trunc(F.date_sub(F.last_day(today), 360), "MM")
