"""Every registered query against its DuckDB twin (row count, columns and an
order-insensitive hash of the values) on the smallest test tables."""

import os

import pytest

import __spark_entry__ as E
from rxcover.plans.oracle import oracle_sql
from rxcover.plans.queries import QUERIES
from tests.conftest import ORACLE_SF
from tools.check_oracle import TABLES, digest, type_mismatches

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{ORACLE_SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, ORACLE_SF)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert not type_mismatches(dict(df.dtypes), dict(zip(rel.columns, [str(t) for t in rel.types])))
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["mapping_status", "n", "pct"]
    assert df.count() >= 1
