"""Every registered query against its DuckDB oracle SQL on the sf0.001 tables."""
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as se
from riskloom.plans.oracle_sql import oracle_queries
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    # exact: doubles must be bit-identical in both engines
    if isinstance(v, (float, Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else repr(v)
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF001)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert srows == orows


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ifrs9_stage", "sector", "loans", "total_ead", "total_ecl", "coverage_ratio"]


def test_every_query_has_oracle_or_is_listed():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
