"""Every registered query with an oracle matches DuckDB at sf0.001 (the driver checks sf0.01)."""

import datetime as dt
import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from sf_paths import SF_SMALL
from skyledger.plans.fixtures import TABLES

ORACLE = entry.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(sdf.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "R_Quartile" in df.columns


def test_every_query_is_registered_with_oracle_or_rows_only():
    names = set(entry.queries())
    assert set(ORACLE) <= names
