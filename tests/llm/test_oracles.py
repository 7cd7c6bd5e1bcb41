"""The operators' queries against their DuckDB SQL (sf0.001)."""

import duckdb
import pytest

from settlekit.llm import queries
from tools.check_oracle import digest, register_views

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_matches_oracle(sc, name):
    con = duckdb.connect()
    register_views(con, SF)
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](sc, SF)
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[1] == digest(columns, want.fetchall())[1]
