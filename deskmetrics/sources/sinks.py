"""Sinks: the report file (S13), the stage snapshot (S14) and schema introspection.

The original writes one spreadsheet from one process. Here every task writes its own
part of the result into a shared folder, so nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: dates in report files are shown day first.
REPORT_DATE_FORMAT = "dd/MM/yyyy"


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header, dates and timestamps as ``dd/MM/yyyy``, no index column."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("dateFormat", REPORT_DATE_FORMAT)
        .option("timestampFormat", REPORT_DATE_FORMAT)
        .option("timestampNTZFormat", REPORT_DATE_FORMAT)
        .csv(path)
    )
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a report file back; every column is text, as written."""
    return spark.read.option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """The stage result as parquet (typed, for machine use)."""
    df.write.mode(mode).parquet(path)
    return path


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """``(column, type)`` pairs, the counterpart of ``get_dtypes``."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
