"""The queries that SQL can express give its rows, run by another engine."""

import glob
import os

import duckdb
import pytest
from loomcat.llm.llm_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*' if os.path.isdir(p) else ''}'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, result.fetchall()))
