"""Registered queries against their DuckDB twins at sf0.001 (the driver's gate, in miniature)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001
from ledgergraph.plans.oracle import oracle_sql
from ledgergraph.plans.queries import queries
from tools.oracle_check import TABLES, digest

ALL = sorted(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["address", "balance", "n_utxo"]
    assert df.count() == 167


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, con, name):
    sp = entry.queries()[name](spark, SF0001).toPandas()
    dd = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert len(sp) and digest(sp) == digest(dd)
