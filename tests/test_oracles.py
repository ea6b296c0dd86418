"""Every catalogue query gives the rows of its SQL, run by another engine."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest
from loomcat.catalogue_queries import FLAGSHIP, ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in sorted(columns)]
    wanted = [tuple(plain(r[k]) for k in at) for r in result.fetchall()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    assert FLAGSHIP(spark, FOLDER).count() > 0
