"""Driver contract and every registered query against its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from arbiter.adapters import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) >= {"group_id", "epoch", "schedule"}
    assert df.count() > 0


def test_registry_consistent():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(rows):
    def c(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(c(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = _canon(sdf.select(*cols).collect())
    odf = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(odf.columns) == cols
    want = _canon(odf[cols].astype(object).where(odf[cols].notna(), None).itertuples(index=False, name=None))
    assert got == want
