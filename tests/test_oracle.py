"""Every SQL-checked driver query against DuckDB on the smallest fixture."""

import os

import duckdb
import pytest

from oracle_check import TABLES, compare

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries

SQL = {k: v for k, v in oracle_sql().items() if k != "pipeline" and not k.startswith("op")}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, queries()[name], SQL[name], SF_SMALL)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert "risk_label" in df.columns and "action" in df.columns


def test_registry_contract():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert own - set(o) == {"train_score", "tune_select"}
    assert all(isinstance(v, str) and v.strip() for v in o.values())
