"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from recollect.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.sql(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def same(spark, con, f, sql):
    df, rel = f(spark, SF), con.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, con, name):
    same(spark, con, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_without_oracle(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
