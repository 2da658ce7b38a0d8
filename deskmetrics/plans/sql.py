"""Parameterised SQL reports (S02): a named SQL text plus the period as named parameters.

The SQL files next to this module use Spark SQL named parameter markers
(``:initial_date``, ``:final_date``, ``:first_day``, ``:last_day``) and are run with
``spark.sql(text, args=...)``; Spark binds the values, nothing is pasted into the text. A
marker without a value is an error: a report over an open period is the DataFrame report's.

Tables are visible as temporary views named ``desk_<logical table>``, so a session's own views
keep their names.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import DataFrame

from ..functions.period import Period
from ..operators.accounts import day_tops
from ..schemas import TABLE_NAMES
from ..sources.tables import Tables


def sql_text(name: str) -> str:
    return resources.files(__package__).joinpath("sql", f"{name}.sql").read_text(encoding="utf-8")


def register_views(tables: Tables, text: str) -> None:
    """The views that ``text`` mentions."""
    for name in TABLE_NAMES:
        if re.search(rf"\bdesk_{name}\b", text):
            getattr(tables, name).createOrReplaceTempView(f"desk_{name}")


def run_sql_report(tables: Tables, name: str, period: Period | None = None, **params) -> DataFrame:
    """Run ``sql/<name>.sql`` with the period (and any further ``params``) bound as named parameters."""
    text = sql_text(name)
    args = {**(period.args() if period else {}), **params}
    if ":day_tops" in text:
        # The largest id of each day: bounded by the calendar, and needed before the text's own pass.
        args["day_tops"] = ",".join(map(str, day_tops(tables.accounts)))
    used = set(re.findall(r":([a-z_]+)", re.sub(r"--.*|'[^']*'", "", text)))
    missing = sorted(k for k in used if args.get(k) is None)
    if missing:
        raise ValueError(f"sql report {name!r} needs a value for {', '.join(missing)}")
    register_views(tables, text)
    return tables.spark.sql(text, args={k: args[k] for k in used})
