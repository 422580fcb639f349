"""Registered training-data queries against their SQL."""

import duckdb
import pytest
from rxcover.llm.queries import ORACLE_SQL, QUERIES

from tests.conftest import ORACLE_SF
from tools.check_oracle import digest, type_mismatches


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ORACLE_SF}/{t}.parquet')")
    df = QUERIES[name](spark, ORACLE_SF)
    rel = con.sql(ORACLE_SQL[name])
    assert not type_mismatches(dict(df.dtypes), dict(zip(rel.columns, [str(t) for t in rel.types])))
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
