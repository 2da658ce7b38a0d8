"""Service-desk tables derived from the TPC-H style test tables.

The reports read tickets, tasks, timers, bridges and users. The test data has orders,
lineitems, customers, suppliers and nations instead, so each service-desk table is a
Spark view over them (the mapping is documented in FIXTURES.md). Every view is a lazy
DataFrame, so its cost grows with the test tables and Catalyst prunes the unused columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHANGE_COLUMNS

# Offset that keeps customer-backed user ids apart from supplier-backed ones.
CUSTOMER_USER_OFFSET = 1_000_000

# Declared layouts of the test tables read here: no footer has to be read on the driver
# to infer them, and a file with a different layout fails instead of shifting columns.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


class FixtureTables:
    """Builds each service-desk table from the test tables below ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            reader = self.spark.read
            if name in RAW_SCHEMAS:
                reader = reader.schema(RAW_SCHEMAS[name])
            self._raw[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # -- items -------------------------------------------------------------
    def item_base(self) -> DataFrame:
        o = self.raw("orders")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        priority_digit = F.substring("o_orderpriority", 1, 1).cast("int")
        solve = F.floor("o_totalprice").cast("bigint")
        return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("date"),
            F.when(F.col("o_orderstatus") == "F", 6)
            .when(F.col("o_orderstatus") == "P", 5)
            .otherwise(2)
            .cast("int")
            .alias("status"),
            (F.lit(1) + F.col("o_orderkey") % 3).cast("int").alias("type"),
            F.col("c_nationkey").alias("itilcategories_id"),
            priority_digit.alias("requesttypes_id"),
            (solve + F.lit(3600) * (F.col("o_orderkey") % 48)).alias("close_delay_stat"),
            solve.alias("solve_delay_stat"),
            add_seconds(F.col("o_orderdate"), solve).alias("solvedate"),
            F.when(F.col("o_orderpriority").like("4%"), F.lit(None))
            .otherwise(
                add_seconds(F.col("o_orderdate"), F.lit(86400) * priority_digit.cast("bigint"))
            )
            .alias("time_to_resolve"),
        )

    def tickets(self) -> DataFrame:
        return self.item_base().filter(F.col("id") % 10 >= 2)

    def changes(self) -> DataFrame:
        return self._change_like(0)

    def problems(self) -> DataFrame:
        return self._change_like(1)

    def _change_like(self, remainder: int) -> DataFrame:
        return self.item_base().filter(F.col("id") % 10 == remainder).select(*CHANGE_COLUMNS)

    # -- dimensions --------------------------------------------------------
    def categories(self) -> DataFrame:
        n = self.raw("nation")
        return n.filter(F.col("n_nationkey") != 0).select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
        )

    def category_weights(self) -> DataFrame:
        n = self.raw("nation")
        return n.filter(F.col("n_nationkey") != 24).select(
            F.col("n_nationkey").alias("items_id"),
            (F.col("n_regionkey") + 1).cast("int").alias("pesofield"),
        )

    def request_types(self) -> DataFrame:
        o = self.raw("orders").select("o_orderpriority").distinct()
        return o.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("id"),
            F.col("o_orderpriority").alias("name"),
        )

    def users(self) -> DataFrame:
        s = self.raw("supplier")
        n = self.raw("nation")
        technicians = s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
            F.col("s_suppkey").alias("id"),
            F.col("n_name").alias("firstname"),
            (F.lit(1) + F.col("s_suppkey") % 3).cast("int").alias("groups_id"),
        )
        customers = self.raw("customer").select(
            (F.lit(CUSTOMER_USER_OFFSET) + F.col("c_custkey")).alias("id"),
            F.col("c_name").alias("firstname"),
            (F.lit(1) + F.col("c_nationkey") % 3).cast("int").alias("groups_id"),
        )
        return technicians.unionByName(customers)

    def accounts(self) -> DataFrame:
        c = self.raw("customer")
        first_order = (
            self.raw("orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("date_creation"))
        )
        return c.join(first_order, c.c_custkey == first_order.o_custkey, "left").select(
            F.col("c_custkey").alias("id"),
            F.col("date_creation"),
            F.when(F.col("c_acctbal") < 0, 0).otherwise(1).cast("int").alias("is_active"),
            F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).cast("int").alias("is_deleted"),
        )

    # -- bridges -----------------------------------------------------------
    def tickets_users(self, item_column: str = "tickets_id") -> DataFrame:
        # Suppliers of odd lines are assigned (type 2), those of even lines observe (type 3).
        li = self.raw("lineitem")
        from_lines = li.select(
            F.col("l_orderkey").alias(item_column),
            F.col("l_suppkey").alias("users_id"),
            F.when(F.col("l_linenumber") % 2 == 1, 2).otherwise(3).cast("int").alias("type"),
        ).distinct()
        observing_customers = self.raw("orders").select(
            F.col("o_orderkey").alias(item_column),
            (F.lit(CUSTOMER_USER_OFFSET) + F.col("o_custkey")).alias("users_id"),
            F.lit(3).cast("int").alias("type"),
        )
        return from_lines.unionByName(observing_customers)

    def changes_users(self) -> DataFrame:
        return self.tickets_users("changes_id")

    def problems_users(self) -> DataFrame:
        return self.tickets_users("problems_id")

    # -- worklog -----------------------------------------------------------
    @staticmethod
    def _task_id() -> Column:
        return F.col("l_orderkey") * 10 + F.col("l_linenumber")

    def tasks(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_shipdate").alias("date"),
            F.min("l_suppkey").alias("users_id_tech"),
            F.floor(F.sum("l_quantity") * 60).cast("bigint").alias("actiontime"),
        ).select(
            self._task_id().alias("id"),
            F.col("l_orderkey").alias("tickets_id"),
            "date",
            "users_id_tech",
            "actiontime",
        )

    def timers(self) -> DataFrame:
        li = self.raw("lineitem")
        plugin_time = (
            F.when(F.col("l_returnflag") == "A", F.lit(0).cast("bigint"))
            .when(F.col("l_returnflag") == "N", F.lit(None).cast("bigint"))
            .when(
                F.col("l_returnflag") == "R",
                F.when(
                    F.col("l_extendedprice") > 50000,
                    F.floor("l_extendedprice") * 100000,
                )
                .otherwise(F.col("l_quantity") * 60)
                .cast("bigint"),
            )
        )
        return li.select(
            self._task_id().alias("tasks_id"),
            F.col("l_shipdate").alias("actual_begin"),
            add_seconds(F.col("l_shipdate"), (F.col("l_quantity") * 3600).cast("bigint")).alias(
                "actual_end"
            ),
            plugin_time.alias("actual_actiontime"),
        )
