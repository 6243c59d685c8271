"""Every named query against its DuckDB oracle on sf0.001 (the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as entry
from sensorwatch.plans.queries import QUERIES
from tools.compare_oracle import duck_connect, rows_multiset

from .conftest import SF_SMALL

NAMES = sorted(QUERIES)  # the optional ones have tests of their own


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) >= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(rows) == len(d_rows) > 0
    assert rows_multiset(df.columns, rows) == rows_multiset(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1062  # FIXTURES.md section 2, sf0.001, 1 min / 30 s
