"""Every registered query runs on the smallest data set; SQL-checkable ones equal DuckDB."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from lakeloom import catalog
from lakeloom.sources.tables import TABLES
from tests.conftest import SF_SMALL

# Rows-only (MLlib training, embeddings): checked for shape, not against SQL.
ROWS_ONLY = {"train_metrics", "batch_inference", "text_classifier", "bakeoff_metrics", "bakeoff_leaderboard",
             "embed_chunks", "retrieve_cited"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    q, o = catalog.queries(), catalog.oracle_sql()
    assert set(q) <= set(entry_mod.queries())
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY


def test_entry_returns_rows(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "revenue_rank" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    cur = con.execute(catalog.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want
