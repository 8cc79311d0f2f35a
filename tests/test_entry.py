"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB on sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from landlens.plans.driver import COVERAGE, ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(smoke_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "PERCENT_CHANGE_IN_LAND_VALUE" in df.columns


def test_entry_serves_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) == set(ORACLE) == set(COVERAGE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, smoke_dir, duck, name):
    df = QUERIES[name](spark, smoke_dir)
    rows = df.collect()
    rel = duck.sql(ORACLE[name])
    cols = rel.columns
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    spark_bag = Counter(tuple(_norm(r[c]) for c in order) for r in rows)
    duck_bag = Counter(tuple(_norm(dict(zip(cols, r))[c]) for c in order) for r in rel.fetchall())
    assert spark_bag == duck_bag
