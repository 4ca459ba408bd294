"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from support import SF_SMALL
from lakemarts.plans.oracle import oracle_queries
from lakemarts.plans.queries import queries
from lakemarts.sources.driver_tables import BASE_TABLES

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "late_delivery_rate_pct" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.execute(oracle_queries()[name])
    d_names = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_names)
    assert _bag(df.columns, df.collect()) == _bag(d_names, res.fetchall())
