"""Corpus pipeline: quality, language, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deskmetrics.llm import jaccard, langid, packing, pii, quality  # noqa: E402
from deskmetrics.llm.common import table  # noqa: E402
from deskmetrics.session import fresh_path, scratch  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality trees accept."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the language models accept as one of the learned languages."""
    return langid.keep_known(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group that Jaccard links make."""
    return jaccard.keep_one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the kind's name."""
    return pii.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_copies", near_copies_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Fitted trees, language models and the packing plan have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage.

    What a stage wrote for itself goes with it; the stages' results stay, or go with the caller's own ``scratch``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
