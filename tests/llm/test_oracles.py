"""The queries that SQL can express agree with it on the smallest tables."""

import duckdb
import pytest

from closure_engine.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    found = QUERIES[name](spark, sf)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, want.fetchall()))
