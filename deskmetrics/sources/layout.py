"""Storage layouts for large installations; which one to take depends on the data.

*Bucketed* (``layout="bucketed"``): the big joins are ticket <-> bridge (on the ticket id) and
timer <-> task (on the task id). Bucketed on those keys (same count on both sides, one
sorted file per bucket) the tables are read back with the partitioning that the sort-merge
join needs: tickets, tasks and timers are not shuffled, nor is a bridge whose users are broadcast (else its narrow rows,
cut to the report's window, go by user and back). Without a shuffle there is nothing that AQE could split: a
task with a large share of the timers is one task's work. Take it where keys are even.

*Dated* (``layout="dated"``): the tables with a date are range-partitioned and sorted by it, so a report's
window prunes files and row groups by their statistics. The joins shuffle, and AQE splits hot
keys on both sides. Take it where keys are skewed or windows are short.

The other tables are written plainly (small dimensions, or joined on other keys).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLE_NAMES
from .tables import Source, Tables

# Bucket column of each table that takes part in a big equi-join.
BUCKET_KEYS = {
    "tickets": "id",
    "tickets_users": "tickets_id",
    "changes": "id",
    "changes_users": "changes_id",
    "problems": "id",
    "problems_users": "problems_id",
    "tasks": "id",
    "timers": "tasks_id",
}


# Date column of each table that reports restrict by a window.
DATE_COLUMNS = {"tickets": "date", "changes": "date", "problems": "date", "tasks": "date", "timers": "actual_begin"}


def write_layout(
    tables: Tables,
    database: str,
    location: str,
    num_buckets: int = 512,
    names=TABLE_NAMES,
    layout: str = "bucketed",
) -> None:
    """Write ``names`` from ``tables`` as catalog tables ``database.<name>`` under ``location``.

    ``num_buckets`` should make one bucket of the largest table a comfortable task
    (for example 128-512 MB of parquet per bucket).
    """
    spark = tables.spark
    root = location.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    if layout not in ("bucketed", "dated"):
        raise ValueError(f"unknown layout {layout!r}")
    for name in names:
        df = getattr(tables, name)
        key = BUCKET_KEYS.get(name) if layout == "bucketed" else None
        day = DATE_COLUMNS.get(name) if layout == "dated" else None
        if key is not None:
            # The same hash as the buckets': every task writes one bucket, every bucket is one file.
            df = df.repartition(num_buckets, key)
        elif day is not None:
            df = df.repartitionByRange(num_buckets, day).sortWithinPartitions(day)
        writer = df.write.mode("overwrite").option("path", f"{root}/{name}")
        if key is not None:
            writer = writer.bucketBy(num_buckets, key).sortBy(key)
        writer.format("parquet").saveAsTable(f"{database}.{name}")


@dataclass(frozen=True)
class CatalogSource(Source):
    """Tables registered in the session catalog (e.g. by ``write_layout``)."""

    database: str

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.database}.{name}")
