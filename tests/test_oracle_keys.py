"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(E.queries()) & set(E.oracle_sql()))  # keys without SQL have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_contract_shape():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 120
    assert set(sqls) <= set(qs)
    assert "revenue_zones" in sqls


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "green_amount", "green_number_records", "yellow_amount",
                          "yellow_number_records", "Borough", "Zone", "service_zone"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert isinstance(rows, list)
        return
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [list(rel.columns).index(c) for c in df.columns]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(df.columns, orows)[0]
