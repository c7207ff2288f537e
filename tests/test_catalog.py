"""Every registered query against its DuckDB twin on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import canon  # noqa: E402
from ptloom.plans.catalog import QUERIES  # noqa: E402
from ptloom.plans.oracle import ORACLE  # noqa: E402
from ptloom.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tool", "rejected_type", "n", "share", "n_errors"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, srows, True) == canon(rel.columns, drows, True)
