"""Fixtures of this folder: tables with odd rows, and the smallest test corpus."""

import pytest

from pyspark.sql import functions as F

EDGE_TEXTS = [
    None, "", " \n\t ", "a", "One two three four five six.", "One two three four five six.", "Ünïcode é ÉÉ 日本  x y 12²",
    "<|endoftext|>a<|ENDOFTEXT|> b|c<|startoftext|>", "x" * 5000, "word " * 4000, "# * $ | | | &\n\n\nHome\nHome", "a@b.co +1 (968) 555-9369 4387513035237269 1.2.3.4",
]
#: Columns that operators use inside, or return.
CLASHING = ("score", "rank", "task", "node", "part", "length", "label", "key", "n", "y", "x", "kind", "cell", "start", "spans", "held_out", "kept", "predicted", "payload", "component_id", "own_id", "h", "line", "w", "p", "k", "carrier", "one", "two", "at", "found", "families", "windows", "mine", "lo", "hi", "word", "slot", "salt", "id", "ids", "base", "piece", "pieces", "count", "total", "task_id")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    rows = [(i, t, ("en", "de", None)[i % 3], None if i % 4 == 0 else f"src{i}", None if i % 5 == 0 else i) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(5, EDGE_TEXTS[5], "en", "src5", 5), (None, "No id here at all, really none.", "en", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def corpus(spark):
    """The documents of the smallest test table, by id."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.collect()}
