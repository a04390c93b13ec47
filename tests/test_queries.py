"""Every registered query against its DuckDB twin on the smallest tables
(the driver repeats this at sf0.01), plus the queries without a twin run to
completion."""

import os
import sys

import duckdb
import pytest

from paths import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from cellar.plans.catalog import TABLES  # noqa: E402
from oracle_check import rows_of  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["k", "cluster", "pos", "name", "value", "description"]
    assert df.count() > 0
