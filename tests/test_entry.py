"""Driver contract: entry, registry and SQL oracles agree on the smallest tables."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as ent  # noqa: E402
from closure_engine.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem", "customer"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert set(df.columns) == {"id", "degree", "triangles", "triplets", "local", "transitivity", "average"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(ent.queries()) and set(ORACLE_SQL) <= set(ent.oracle_sql()) <= set(ent.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 12)
    return v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    res = con.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in sorted(cols)]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
