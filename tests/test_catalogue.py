import os

import pytest

import __spark_entry__ as entry
from tesserae.plans import catalogue

DATA = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_names():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@here
def test_entry(spark):
    assert entry.entry(spark).columns == ["entropy_red", "prefix_red", "opening_red", "red"]


@here
@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    mine, theirs = catalogue.QUERIES[name](spark, DATA), con.execute(catalogue.SQL[name]).df()
    cols = sorted(mine.columns)
    assert cols == sorted(theirs.columns)

    def value(x):
        if hasattr(x, "tolist"):
            x = x.tolist()
        if isinstance(x, (list, tuple)):
            return tuple(map(value, x))
        return None if x is None or x != x else round(float(x), 9) if isinstance(x, (int, float)) else x

    a = sorted((tuple(value(r[c]) for c in cols) for r in mine.collect()), key=str)
    b = sorted((tuple(value(x) for x in r) for r in theirs[cols].astype(object).itertuples(index=False)), key=str)
    assert a == b


def test_filters_reach_the_scan(spark):
    if os.path.isdir(DATA):
        plan = catalogue.QUERIES["review_approved"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<sft_id:bigint,image:string,question:string>" in plan and "CartesianProduct" not in plan
