"""Every registered query against its DuckDB oracle (rows, column names, values)."""

import pytest

import __spark_entry__ as E
from compare import canon, duck
from conftest import SF_SMALL

# The optional training-data queries have tests of their own.
QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: t for k, t in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert len(got) == len(want)
    gcols, gh = canon(got)
    wcols, wh = canon(want)
    assert gcols == wcols
    assert gh == wh


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 473
    assert df.columns[:2] == ["Técnico", "Data"]


SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(ORACLES[name])
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == want
