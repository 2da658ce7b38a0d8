"""Row predicates (F01-F08), all built-in Column expressions.

Date ranges compare ``to_date(ts)`` with literal dates; Catalyst turns that into a raw
timestamp range, so the predicate reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FINISHED_STATUSES
from .period import DateLike, _as_date


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_dates(c: Column | str, first: DateLike | None, last: DateLike | None) -> Column:
    """calendar date of ``c`` within ``first..last``, both ends inclusive.

    An absent bound is left out rather than compared with an empty value.
    """
    d = F.to_date(_col(c))
    cond = F.lit(True)
    first, last = _as_date(first), _as_date(last)
    if first is not None:
        cond = cond & (d >= F.lit(first))
    if last is not None:
        cond = cond & (d <= F.lit(last))
    return cond


def interval_inside(begin: Column | str, end: Column | str, first, last) -> Column:
    """both the start and the end of an interval lie in the window."""
    return in_dates(begin, first, last) & in_dates(end, first, last)


def finished(status: Column | str = "status") -> Column:
    """solved or closed."""
    return _col(status).isin(*FINISHED_STATUSES)


def has_technician(tech: Column | str = "users_id_tech") -> Column:
    """a task technician is set (0 and null both mean none)."""
    return _col(tech) != 0


def active_account(is_deleted="is_deleted", is_active="is_active", created="date_creation") -> Column:
    """F05 + F06: active, not deleted, with a creation date. Flags may be integers or booleans."""
    return (_col(is_deleted).cast("int") == 0) & (_col(is_active).cast("int") == 1) & _col(created).isNotNull()


def not_excluded(name: Column | str, excluded: Iterable[str]) -> Column:
    """drop the listed names but keep rows whose name is null."""
    names = list(excluded)
    if not names:
        return F.lit(True)
    return F.coalesce(~_col(name).isin(*names), F.lit(True))


def observer_eligible(
    groups=(1, 2), excluded_ids=(6,), group_col="groups_id", id_col="id", name_col="firstname"
) -> Column:
    """F08 (+ F06 on the name): users that may show up as observers."""
    cond = _col(group_col).isin(*groups) & _col(name_col).isNotNull()
    if excluded_ids:
        cond = cond & ~_col(id_col).isin(*excluded_ids)
    return cond
