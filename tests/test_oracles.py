"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pagelake.plans.oracle_sql import oracle_queries
from pagelake.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(E.queries()) and set(oracle_queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(oracle_queries()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    srows, orows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(srows) == len(orows)
    assert _bag(df.columns, srows) == _bag(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "record_id" in df.columns
