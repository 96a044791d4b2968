"""Queries that SQL can express against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from gridlake.llm.queries import ORACLES, QUERIES
from gridlake.plans.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import canon


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(df.columns, rows, False) == canon(cols, cur.fetchall(), False)
