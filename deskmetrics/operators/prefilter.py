"""A bridge cut to a report's items where it is scanned: by a Bloom filter, or by the ids themselves if they are few.

A report over a window joins the window's items with bridges that hold all history. The join alone would shuffle all of it to drop
most afterwards. ``id_filter`` lets only rows of the window's items pass, before any exchange:

* up to ``spark.deskmetrics.broadcast.maxRows`` ids, a semi join with the broadcast ids;
* up to ``MAX_IDS`` ids (setting ``spark.deskmetrics.prefilter.maxIds``, 0 = no filters), a Bloom filter: an array of 64-bit words, where an id's
  hash picks a word and ``BITS`` bits of it. A row whose bits are not all set belongs to no item; the few others that pass by chance are
  dropped by the join, so results do not depend on the filter. The array is a scalar subquery: Spark computes it in the same query (partial
  ORs per task, one row per word) and sends it to the tasks. Its size follows the counted ids, ``IDS_PER_WORD`` to a word: 8 MB at most;
* beyond that, or where the items have a large share of the bridge anyway (fewer than ``WORTH`` bridge rows for each id), none: the
  bridge is shuffled whole, as the join by itself does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import max_broadcast_rows

BITS = 4
IDS_PER_WORD = 4
WORTH = 4
MAX_IDS = 4_194_304
MAX_IDS_CONF = "spark.deskmetrics.prefilter.maxIds"


def max_ids(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(MAX_IDS_CONF, None)
    return MAX_IDS if value in (None, "") else int(value)


def _hash(*key: Column) -> Column:
    """Keys of one kind hash alike, whatever their integer types."""
    return F.xxhash64(*[k.cast("bigint") for k in key])


def _word(h: Column, words: int) -> Column:
    return F.pmod(h, F.lit(words)).cast("int")


def _mask(h: Column) -> Column:
    """``BITS`` bits of a word, from the upper half of the hash."""
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 32 + 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


@dataclass(frozen=True)
class IdFilter:
    """``ids``: the items' keys; ``bits``: the Bloom filter as a subquery column, with its number of words, unless the ids are broadcast."""

    ids: DataFrame
    bits: Column | None = None
    words: int = 0

    def cut(self, rows: DataFrame, *key: Column) -> DataFrame:
        """``rows`` without those whose key is surely not among the ids (null keys never are)."""
        if self.bits is not None:
            return rows.filter(self.may_contain(*key))
        ids = F.broadcast(self.ids.toDF(*[f"__keep{i}" for i in range(len(key))]))
        on = F.lit(True)
        for i, k in enumerate(key):
            on = on & (k == F.col(f"__keep{i}"))
        return rows.join(ids, on, "left_semi")

    def may_contain(self, *key: Column) -> Column:
        h = _hash(*key)
        found = F.element_at(self.bits, _word(h, self.words) + 1)
        present = F.lit(True)
        for k in key:
            present = present & k.isNotNull()
        return present & (found.bitwiseAND(_mask(h)) == _mask(h))


def id_filter(ids: DataFrame, n: int, bridge_rows: int | None = None) -> IdFilter | None:
    """The filter of the rows of ``ids`` (all of its columns are the key), ``n`` of them at most, for a bridge of ``bridge_rows``."""
    if n > max_ids(ids) or (bridge_rows is not None and n * WORTH > bridge_rows):
        return None
    return IdFilter(ids) if n <= max_broadcast_rows(ids) else bloom_filter(ids, n)


def bloom_filter(ids: DataFrame, n: int) -> IdFilter:
    words = 64
    while words * IDS_PER_WORD < n:
        words *= 2
    h = _hash(*[F.col(c) for c in ids.columns])
    marked = ids.select(_word(h, words).alias("word"), _mask(h).alias("mask"))
    # One row of no bits for each word, so that every place of the array is there.
    every = ids.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    packed = marked.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    array = packed.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("bits"))
    return IdFilter(ids, array.scalar(), words)
