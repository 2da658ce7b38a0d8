"""Heavy hitters: the few keys of a bridge that hold a large share of its rows.

One pass with a mergeable sketch (``approx_top_k``: each task keeps ``TRACKED`` counters, the driver gets at most ``TOP`` keys). The sketch
overestimates a count by at most a few rows in ``TRACKED``, so every key with more than one row in ``TOP`` is found. A key is
hot when it also has more than ``HOT_ROWS`` rows (setting ``spark.deskmetrics.fanout.hotRows``): below that a task takes it easily.

The list only decides how rows travel (``joins.fan_out_join``), never which rows come out, so it may be older than the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP = 1_000
TRACKED = 16_384
HOT_ROWS = 100_000
HOT_ROWS_CONF = "spark.deskmetrics.fanout.hotRows"


def hot_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return HOT_ROWS if value in (None, "") else int(value)


@dataclass(frozen=True)
class Hot:
    """Rows of a table when it was looked at, and its hot keys (at most ``TOP``)."""

    rows: int
    keys: tuple


def heavy_keys(df: DataFrame, key: str) -> Hot:
    sketch = F.expr(f"approx_top_k(`{key}`, {TOP}, {TRACKED})").alias("top")
    found = df.agg(F.count(F.lit(1)).alias("rows"), sketch).first()
    limit = max(hot_rows(df), found["rows"] // TOP)
    return Hot(found["rows"], tuple(sorted(t["item"] for t in found["top"] or () if t["item"] is not None and t["count"] > limit)))
