"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import collections

import duckdb
import pytest

import __spark_entry__ as se
from salesmart.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "supplier", "part", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    return "NULL" if v is None else (repr(round(v, 9)) if isinstance(v, float) else str(v))


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "margin" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    qs, oracle = set(se.queries()), set(se.oracle_sql())
    assert oracle <= qs
    assert set(catalog.QUERIES) - oracle == se.ROWS_ONLY


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    oracle = se.oracle_sql().get(name)
    if oracle is None:
        assert len(rows) > 0
        return
    res = con.execute(oracle)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)
