"""Table sources: one ``load_table`` for parquet folders, JDBC databases and test fixtures.

A report asks for tables by logical name (``tickets``, ``tasks``...). Which storage backs
them is the source's business:

* ``ParquetSource(root)`` reads ``root/<name>.parquet`` (a file or a folder of parts);
* ``JdbcSource(url, ...)`` reads the database table through Spark's JDBC reader, split
  into ranges of a numeric key, whose least and largest value and row count are measured first, so
  a large table is fetched by many tasks in parallel instead of one connection;
* ``FixtureSource(sf_dir)`` derives the tables from the TPC-H style test data.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DATABASE_TABLES, TABLE_COLUMNS, TABLE_NAMES
from .fixtures import FixtureTables


class Source:
    def load(self, spark: SparkSession, name: str) -> DataFrame:  # pragma: no cover
        raise NotImplementedError


@dataclass(frozen=True)
class ParquetSource(Source):
    """``root/<name>.parquet`` per table. ``schemas`` (table -> DDL string) declares the
    layouts: the driver then reads no footer to infer them, and a file whose layout
    drifted fails instead of shifting columns."""

    root: str
    schemas: dict = field(default_factory=dict)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


#: Numeric key by whose ranges each table is read from a database.
RANGE_KEYS = {
    "tickets": "id",
    "tasks": "id",
    "timers": "tasks_id",
    "tickets_users": "tickets_id",
    "users": "id",
    "accounts": "id",
    "categories": "id",
    "category_weights": "items_id",
    "request_types": "id",
    "changes": "id",
    "changes_users": "changes_id",
    "problems": "id",
    "problems_users": "problems_id",
}


@dataclass(frozen=True)
class Measured:
    """A table's least and largest key (None without any) and its rows, as they were when the source looked."""

    low: int | None
    high: int | None
    rows: int

    def predicates(self, key: str, rows_per_task: int, most: int) -> list[str]:
        """Conditions that share out the measured keys in ranges of equal width, each row to one of them; null keys go first.

        Keys above the largest measured one are left out: what is inserted after the measurement is in no table."""
        if self.low is None:
            return [f"{key} IS NULL"]
        parts = max(1, min(most, -(-self.rows // rows_per_task), self.high - self.low + 1))
        width = self.high - self.low + 1
        cuts = [self.low + width * i // parts for i in range(parts)]
        out = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
        out.append(f"{key} >= {cuts[-1]} AND {key} <= {self.high}")
        out[0] = f"({out[0]}) OR {key} IS NULL"
        return out


@dataclass(frozen=True)
class JdbcSource(Source):
    """Spark JDBC reader settings.

    The first table that is asked for has all tables measured by one statement (``bounds_query``), hence as of one moment; each
    table is then read by tasks of about ``rows_per_task`` rows, ``num_partitions`` at most, each a range of the table's key
    (``RANGE_KEYS``). ``partition_bounds`` maps a table name to ``(column, lower, upper)`` instead: that table is not measured and is
    read in ``num_partitions`` ranges; those bounds only decide the split, rows outside them are still read.
    """

    url: str
    properties: dict = field(default_factory=dict)
    partition_bounds: dict = field(default_factory=dict)
    num_partitions: int = 64
    fetch_size: int = 10_000
    rows_per_task: int = 1_000_000
    measured: dict = field(default_factory=dict, compare=False)

    def options(self, name: str) -> dict[str, str]:
        opts = {
            "url": self.url,
            "dbtable": self.dbtable(name),
            "fetchsize": str(self.fetch_size),
        }
        opts.update({k: str(v) for k, v in self.properties.items()})
        if name in self.partition_bounds:
            column, lower, upper = self.partition_bounds[name]
            opts.update(
                {
                    "partitionColumn": column,
                    "lowerBound": str(lower),
                    "upperBound": str(upper),
                    "numPartitions": str(self.num_partitions),
                }
            )
        return opts

    @staticmethod
    def dbtable(name: str) -> str:
        table = DATABASE_TABLES[name]
        if name == "accounts":
            # The account columns of the users table.
            return f"(SELECT {', '.join(TABLE_COLUMNS['accounts'])} FROM {table}) accounts"
        return table

    def bounds_query(self) -> str:
        """One statement for the key range and the rows of every table that has no bounds of its own."""
        names = [name for name in RANGE_KEYS if name not in self.partition_bounds]
        each = [
            f"SELECT '{n}' AS name, MIN({RANGE_KEYS[n]}) AS low, MAX({RANGE_KEYS[n]}) AS high, COUNT(*) AS n FROM {DATABASE_TABLES[n]}" for n in names
        ]
        return f"({' UNION ALL '.join(each)}) bounds"

    def measure(self, rows: Iterable) -> None:
        """Take over the rows of ``bounds_query``."""
        for r in rows:
            ends = [None if r[c] is None else int(r[c]) for c in ("low", "high")]
            self.measured[r["name"]] = Measured(*ends, int(r["n"]))

    def predicates(self, name: str) -> list[str]:
        return self.measured[name].predicates(RANGE_KEYS[name], self.rows_per_task, self.num_partitions)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        if name in self.partition_bounds:
            return spark.read.format("jdbc").options(**self.options(name)).load()
        if not self.measured:
            self.measure(spark.read.format("jdbc").options(**{**self.options(name), "dbtable": self.bounds_query()}).load().collect())
        properties = {**{k: str(v) for k, v in self.properties.items()}, "fetchsize": str(self.fetch_size)}
        return spark.read.jdbc(self.url, self.dbtable(name), predicates=self.predicates(name), properties=properties)


class FixtureSource(Source):
    def __init__(self, sf_dir: str):
        self.sf_dir = sf_dir
        self._fixtures: FixtureTables | None = None

    def fixtures(self, spark: SparkSession) -> FixtureTables:
        if self._fixtures is None or self._fixtures.spark is not spark:
            self._fixtures = FixtureTables(spark, self.sf_dir)
        return self._fixtures

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return getattr(self.fixtures(spark), name)()

    def raw(self, spark: SparkSession, name: str) -> DataFrame:
        """One of the underlying test tables (declared schema)."""
        return self.fixtures(spark).raw(name)


def load_table(spark: SparkSession, name: str, source: Source) -> DataFrame:
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}; expected one of {', '.join(TABLE_NAMES)}")
    return source.load(spark, name)


class Tables:
    """Lazy, per-name access to the tables of one source (``tables.tickets`` ...)."""

    def __init__(self, spark: SparkSession, source: Source):
        self.spark = spark
        self.source = source
        self._cache: dict[str, DataFrame] = {}
        self._remembered: dict = {}

    def remembered(self, key, find):
        """What ``find()`` says about the tables, found out once. For facts that steer plans and never results."""
        if key not in self._remembered:
            self._remembered[key] = find()
        return self._remembered[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = load_table(self.spark, name, self.source)
        return self._cache[name]

    @classmethod
    def fixtures(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        return cls(spark, FixtureSource(sf_dir))
