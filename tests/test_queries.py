"""Every registered query against its SQL twin on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from cladeframe.plans import queries as plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, list) else str(v)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, con, name):
    df = plans.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in plans.ORACLE:
        con.execute(plans.ORACLE[name])
        named = [c[0] for c in con.description]
        assert sorted(named) == cols
        want = sorted(tuple(plain(r[named.index(c)]) for c in cols) for r in con.fetchall())
        assert [tuple(map(lambda x: x.replace("-0", "0") if x == "-0" else x, r)) for r in rows] == [tuple(map(lambda x: x.replace("-0", "0") if x == "-0" else x, r)) for r in want]


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
