import os

import pytest

from tesserae.llm import queries, sql

DATA = "/root/testdata/sf0.001"


def value(x):
    return None if x is None or x != x else round(float(x), 9) if isinstance(x, (int, float)) else x


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    mine, theirs = queries.QUERIES[name](spark, DATA), con.execute(sql.SQL[name])
    at = [c[0] for c in theirs.description]
    cols = sorted(mine.columns)
    assert cols == sorted(at)
    a = sorted((tuple(value(r[c]) for c in cols) for r in mine.collect()), key=str)
    b = sorted((tuple(value(r[at.index(c)]) for c in cols) for r in theirs.fetchall()), key=str)
    assert a == b
