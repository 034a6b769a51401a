"""Every registered query against its DuckDB oracle at sf0.001 (the driver
does the same at sf0.01), plus the driver contract itself."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from formweave.plans.oracles import ORACLES, ROWS_ONLY, SF_DIR
from formweave.plans.registry import QUERIES, TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{smoke_dir}/{t}.parquet')")
    return c


def test_contract_keys():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)
    assert set(QUERIES) - set(ORACLES) == set(ROWS_ONLY)
    assert set(QUERIES) <= set(qs) and set(ORACLES) <= set(os_)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["subid", "redcap_event_name", "race"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, smoke_dir, name):
    df = E.queries()[name](spark, smoke_dir)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    r = con.sql(E.oracle_sql()[name].replace(SF_DIR, smoke_dir))
    ocols, orows = r.columns, r.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(srows, scols) == _canon(orows, ocols)

