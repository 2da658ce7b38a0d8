"""The database source: measured key ranges. No database runs here; the texts it would send run in DuckDB's own process."""

import duckdb
import pytest

from deskmetrics.schemas import DATABASE_TABLES, TABLE_NAMES
from deskmetrics.sources import tables as S
from deskmetrics.sources.tables import RANGE_KEYS, JdbcSource, Measured


@pytest.fixture()
def database():
    """The database tables with their keys only: gaps, repeats, null keys, negative keys, an empty table."""
    con = duckdb.connect()
    for i, table in enumerate(sorted(set(DATABASE_TABLES.values()))):
        keys = {RANGE_KEYS[n] for n, t in DATABASE_TABLES.items() if t == table}
        assert len(keys) == 1
        rows = 0 if i == 0 else 40 * i
        con.execute(f"CREATE TABLE {table} AS SELECT CASE WHEN r % 17 = 3 THEN NULL ELSE (r * r) % 977 - 50 END AS {keys.pop()} FROM range({rows}) q(r)")
    return con


def measured(con, **kwargs):
    source = JdbcSource("jdbc:x", num_partitions=7, rows_per_task=50, **kwargs)
    result = con.execute(f"SELECT * FROM {source.bounds_query()}")
    names = [d[0] for d in result.description]
    source.measure([dict(zip(names, row)) for row in result.fetchall()])
    return source


def test_every_table_is_measured_by_one_statement_and_every_row_read_once(database):
    source = measured(database)
    assert set(source.measured) == set(TABLE_NAMES) == set(RANGE_KEYS)
    for name in TABLE_NAMES:
        table, ranges = DATABASE_TABLES[name], source.predicates(name)
        n = database.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
        assert len(ranges) == max(1, min(7, -(-n // 50)))
        found = [database.execute(f"SELECT count(*) FROM {table} WHERE {p}").fetchone()[0] for p in ranges]
        assert sum(found) == n
        hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in ranges)
        assert database.execute(f"SELECT count(*) FROM {table} WHERE {hits} <> 1").fetchone()[0] == 0


def test_rows_inserted_after_the_measurement_are_in_no_range(database):
    source = measured(database)
    before = source.measured["tickets"]
    database.execute(f"INSERT INTO glpi_tickets VALUES ({before.high + 1})")
    assert sum(database.execute(f"SELECT count(*) FROM glpi_tickets WHERE {p}").fetchone()[0] for p in source.predicates("tickets")) == before.rows


def test_ranges_of_odd_tables():
    assert Measured(None, None, 0).predicates("id", 10, 4) == ["id IS NULL"]
    assert Measured(5, 5, 900).predicates("id", 10, 4) == ["(id >= 5 AND id <= 5) OR id IS NULL"]
    assert Measured(0, 9, 30).predicates("id", 10, 64) == ["(id >= 0 AND id < 3) OR id IS NULL", "id >= 3 AND id < 6", "id >= 6 AND id <= 9"]
    assert len(Measured(1, 10**12, 10**12).predicates("id", 10**6, 4000)) == 4000


class Reader:
    """Stands for ``spark.read``: notes what is asked of it."""

    def __init__(self):
        self.asked = []

    def format(self, name):
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        return self

    def collect(self):
        return [{"name": n, "low": 1, "high": 100, "n": 3_000_000} for n in TABLE_NAMES]

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"url": url, "table": table, "predicates": predicates, "properties": properties})
        return self


def test_tables_load_in_ranges_after_one_measurement():
    spark = type("Session", (), {"read": Reader()})()
    source = JdbcSource("jdbc:x", {"user": "u"}, {"tasks": ("id", 1, 9)})
    for name in TABLE_NAMES:
        S.load_table(spark, name, source)
    asked = spark.read.asked
    assert sum("bounds" in str(a.get("dbtable", "")) for a in asked) == 1
    assert "'tasks'" not in source.bounds_query()
    ranged = {a["table"]: a for a in asked if "predicates" in a}
    assert len(ranged) == len(TABLE_NAMES) - 1 and all(len(a["predicates"]) == 3 for a in ranged.values())
    assert ranged["glpi_tickets"]["properties"] == {"user": "u", "fetchsize": "10000"}
    assert [a["partitionColumn"] for a in asked if "partitionColumn" in a] == ["id"]
