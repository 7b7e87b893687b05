"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tools.check import duck, rows_of

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(SQLS))
def test_query_matches_oracle(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQLS[key])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, srows) == rows_of(dcols, drows)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only_queries_run(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.columns
    df.collect()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns
