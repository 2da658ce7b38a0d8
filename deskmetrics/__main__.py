"""Run the batch job: ``python -m deskmetrics --parquet ROOT --out DIR [--mode geral|anual]``.

Writes the ticket, worklog and account reports, or those that ``--report`` names (CSV, dates day
first; summaries in key order), below ``--out`` and prints one line per report with its row
count. The window is the mode's, or ``--initial`` to ``--final``. The library's settings are given to the
session before it starts, where the cluster's configuration leaves them unset.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .session import DEFAULT_CONF
from .sources.tables import FixtureSource, JdbcSource, ParquetSource, Tables


REPORTS = (
    "tickets", "worklog", "accounts", "changes", "problems", "combined", "observed",
    "ticket_summary", "worklog_summary", "observer_summary",
)


def session(conf=DEFAULT_CONF):
    """A session with ``conf`` for every key that spark-submit or the defaults file leaves unset.

    Static settings have to be there before the context is."""
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    given = SparkConf()
    builder = SparkSession.builder.appName("deskmetrics")
    for key, value in conf.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="deskmetrics", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet", metavar="ROOT", help="folder with <table>.parquet per table")
    src.add_argument("--catalog", metavar="DATABASE", help="catalog database (see sources.layout)")
    src.add_argument("--jdbc-url", metavar="URL", help="JDBC URL of the service-desk database")
    src.add_argument("--fixtures", metavar="SF_DIR", help="TPC-H style test tables")
    p.add_argument("--jdbc-user", default=None)
    p.add_argument("--jdbc-password-env", default=None, help="environment variable holding the password")
    p.add_argument(
        "--jdbc-bounds", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER",
        help="read TABLE in ranges of COLUMN between these bounds instead of measured ones (repeatable)",
    )
    p.add_argument("--jdbc-partitions", type=int, default=64, help="parallel ranges per table, at most")
    p.add_argument("--jdbc-rows", type=int, default=1_000_000, help="rows that one range should have")
    p.add_argument("--out", required=True, help="shared folder for the reports")
    p.add_argument("--mode", choices=("geral", "anual"), default="geral")
    p.add_argument("--today", default=None, help="reference date (default: today)")
    p.add_argument("--initial", type=dt.date.fromisoformat, default=None, help="first day of the window (with --final)")
    p.add_argument("--final", type=dt.date.fromisoformat, default=None, help="last day of the window")
    p.add_argument("--report", action="append", choices=REPORTS, help="report to write (repeatable)")
    p.add_argument("--sequential", action="store_true", help="run the reports one after another")
    args = p.parse_args(argv)
    if (args.initial is None) != (args.final is None):
        p.error("--initial and --final go together")
    for bound in args.jdbc_bounds:
        if bound.count(":") != 3:
            p.error(f"--jdbc-bounds {bound}: expected TABLE:COLUMN:LOWER:UPPER")
    return args


def main(argv=None) -> None:
    import os

    from .functions.period import Period
    from .plans.reports import run_all
    from .sources.layout import CatalogSource

    args = parse_args(argv)
    spark = session()

    if args.parquet:
        source = ParquetSource(args.parquet)
    elif args.catalog:
        source = CatalogSource(args.catalog)
    elif args.fixtures:
        source = FixtureSource(args.fixtures)
    else:
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        bounds = {t: (c, low, high) for t, c, low, high in (b.split(":") for b in args.jdbc_bounds)}
        source = JdbcSource(args.jdbc_url, props, bounds, args.jdbc_partitions, rows_per_task=args.jdbc_rows)

    today = dt.date.fromisoformat(args.today) if args.today else dt.date.today()
    period = Period.of(args.initial, args.final) if args.initial else None
    wanted = args.report or REPORTS[:3]
    counts = run_all(Tables(spark, source), args.out, args.mode, today, None, not args.sequential, period, wanted)
    for row in counts.collect():
        print(json.dumps({"report": row["report"], "rows": row["linhas"], "path": f"{args.out}/{row['report']}"}))


if __name__ == "__main__":
    main()
