import os

import pytest

import __spark_entry__ as contract
from askloom.catalog import REGISTER

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", [n for n, q in REGISTER.items() if q.sql])
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_entry(spark):
    assert contract.entry(spark).count() == 240
