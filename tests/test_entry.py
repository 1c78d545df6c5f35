"""Registered jobs against their DuckDB oracles on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, decimal.Decimal):
        return int(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def rows(cols, it):
    return sorted((tuple(norm(x) for x in r) for r in it), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"tx_hash", "p0", "p6"} <= set(df.columns)


def test_every_query_has_an_entry_and_oracles_are_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    got = rows(cols, ([r[c] for c in cols] for r in df.collect()))
    idx = [rel.columns.index(c) for c in cols]
    want = rows(cols, ([r[i] for i in idx] for r in rel.fetchall()))
    assert got == want
