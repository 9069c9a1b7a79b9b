"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry
from carryall.plans.fixtures import TABLES
from carryall.plans.registry import load

duckdb = pytest.importorskip("duckdb")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_query_equals_sql(spark, engine, name):
    df = load()[0][name](spark, SMALL)
    columns = sorted(df.columns)
    got = Counter(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    found = engine.execute(load()[1][name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(repr(tuple(r[i] for i in order)) for r in found.fetchall())
    assert got - want == Counter() and want - got == Counter()
    assert want, "an empty result checks nothing"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_returnflag", "l_linestatus", "kind", "n_src", "n_dst"]
    assert df.count() == 4
