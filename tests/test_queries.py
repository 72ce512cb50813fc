"""Every query with SQL against DuckDB, and the entry, over the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sievework import queries as core


def tidy(values):
    return tuple("null" if v is None or v != v else f"{round(float(v), 9):.9g}" if isinstance(v, float) else str(v) for v in values)


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_equals_sql(spark, sf, sql, name):
    got = core.QUERIES[name](spark, sf)
    want = sql.execute(core.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(tidy(r) for r in got.select(*sorted(names)).collect()) == sorted(tidy(dict(zip(names, r))[n] for n in sorted(names)) for r in want.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_weighted_sample_is_stable_and_in_proportion(spark, sf):
    one = {tuple(r) for r in core.QUERIES["weighted_sample"](spark, sf).collect()}
    assert one == {tuple(r) for r in core.QUERIES["weighted_sample"](spark, sf).collect()}
    assert all(r[1] or r[0] for r in one) and math.isfinite(len(one))
