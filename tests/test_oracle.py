"""Every registered query against its SQL, types and values."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

from paths import TESTDATA  # noqa: E402

SF_DIR = f"{TESTDATA}/{os.environ.get('FERRYLINE_TEST_SF', 'sf0.01')}"
#: Queries that SQL can express; the operators of the llm package have tests of their own.
QUERIES = {k: q for k, q in contract.queries().items() if k not in contract.LLM_QUERIES}


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM read_parquet('{SF_DIR}/{file}')")
    return con


# Spark type names and what they are called in the oracle.
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_an_oracle():
    assert set(contract.oracle_sql()) - set(contract.LLM_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    result = oracle.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    theirs = dict(zip(result.columns, map(str, result.types)))
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    assert {c: SAME_TYPE.get(t, t.upper()) for c, t in ours.items()} == theirs

    picked = result.select(*[duckdb.ColumnExpression(c) for c in columns])
    expected = sorted(map(repr, picked.fetchall()))
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert len(got) == len(expected)
    assert got == expected
