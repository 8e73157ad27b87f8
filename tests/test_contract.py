"""Every registered query against its SQL counterpart."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from contract import oracle
from contract.spark_queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
SQL = oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    found = [tuple(r) for r in df.collect()]
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(found, df.columns) == _sorted(result.fetchall(), columns)


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_flagship(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert "tc_anual_sbc" in df.columns
