import duckdb
import pytest

from sensorwatch.llm.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DIR).toPandas()
    assert len(got)
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "conversations", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        want = con.sql(ORACLE[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        rows = lambda d: sorted(map(tuple, d[cols].convert_dtypes().astype(str).values.tolist()))
        assert rows(got) == rows(want)
