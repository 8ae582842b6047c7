"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from noticeflow.plans import queries as Q
from tests.conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_every_query_has_an_oracle():
    missing = set(Q.queries()) - set(E.oracle_sql())
    assert not missing and set(Q.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
