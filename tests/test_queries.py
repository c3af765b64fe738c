"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from vellum.plans import catalog, views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in views.TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([str(plain(r[i])) for i in order] for r in values))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = duck.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, map(tuple, got)) == rows(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["page", "pos", "text", "k", "unstable"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
