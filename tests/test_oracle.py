"""Differential test: every query of the catalog vs its DuckDB oracle SQL on
the smallest driver tables (the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pitchline.catalog.compare import compare, register_tables
from pitchline.catalog.oracle import ORACLE
from pitchline.catalog.queries import QUERIES
from pitchline.sources.tables import TABLE_NAMES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SF_SMALL, TABLE_NAMES)
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], missing


def test_entry_registers_them():
    assert QUERIES.keys() <= E.queries().keys() and ORACLE.keys() <= E.oracle_sql().keys()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "overall_rank" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    problems = compare(QUERIES[key](spark, SF_SMALL), con, ORACLE[key])
    assert problems == [], problems
