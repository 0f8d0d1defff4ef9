"""Every registered batch query against its DuckDB oracle on sf0.001 (the driver runs sf0.01)."""

import hashlib
import json
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from sensorlake.plans.queries import QUERIES

TABLES = "events".split()


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _digest(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted(json.dumps([_norm(r[c]) for c in cols], default=str) for r in df.to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    d = con.execute(entry.oracle_sql()[name]).df()
    d = d.astype(object).where(d.notna(), None)
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _digest(s) == _digest(d)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "late_class" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = {"progress_log", "state_snapshot", "stream_performance"}
    own = set(entry.queries()) - set(entry.LLM_QUERIES)   # the optional part keeps account of its own queries
    assert own - set(entry.oracle_sql()) == rows_only
