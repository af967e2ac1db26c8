"""Every registered query equals its DuckDB SQL (small scale factor)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

import sys, os  # noqa: E401
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, digest  # noqa: E402

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_equals_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "event_name", "error_count", "total_count"]
    assert df.count() >= 0
