"""Every registered query against its independent DuckDB SQL (sf0.001)."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, register_views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_views(c, SF)
    return c


OWN = [n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n)]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 146 and df.count() > 0
