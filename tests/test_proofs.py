"""Every registered proof against its DuckDB oracle on the smallest tables (the driver's check, at sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from gridlake.plans.registry import load_all
from gridlake.plans.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import canon

PROOFS = load_all()
QUERIES = {n: p.fn for n, p in PROOFS.items()}
ORACLE = {n: p.sql for n, p in PROOFS.items()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_proof_registered_with_ids():
    for name, p in PROOFS.items():
        assert p.ids, f"{name} lists no SURVEY ids"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["r_regionkey", "r_name", "n_customers", "mean_price", "pct_high"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_proof_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    sql = ORACLE.get(name)
    assert sql is not None, "every proof has an oracle"
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert canon(s_cols, s_rows, False) == canon(o_cols, o_rows, False)


ZONE_SENSITIVE = ["hour_bucket_join", "gold_binned_join", "missing_periods", "lateness_report", "scd2_collapsed", "silver_latest_pull"]


@pytest.mark.parametrize("tz", ["Asia/Kolkata", "America/Sao_Paulo"])
@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_proof_independent_of_session_zone(spark, con, name, tz):
    """Zone-free data must give the same answer whatever the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = QUERIES[name](spark, SF_SMALL)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = con.execute(ORACLE[name])
    o_cols = [d[0] for d in cur.description]
    assert canon(s_cols, s_rows, False) == canon(o_cols, cur.fetchall(), False)
