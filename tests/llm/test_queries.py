"""Registered queries against their oracle SQL on the smallest tables."""

import duckdb
import pytest

from cartflow.llm.queries import QUERIES, SQL
from llm_help import SF_SMALL

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    told = con.sql(SQL[name])
    told.create_view("told")  # as the gate does
    got = QUERIES[name](spark, SF_SMALL)
    columns = sorted(got.columns)
    assert columns == sorted(told.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM told").fetchall()
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want))
