"""The queries that SQL can express, against that SQL over whole tables."""

import duckdb
import pytest

from askloom.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def normal(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    # A whole number that may be null is a float in one frame and not in the other.
    got = got.astype({c: "Int64" for c in got.columns if str(want[c].dtype) == "Int64"})
    assert {c: str(t) for c, t in got.dtypes.items()} == {c: str(want[c].dtype) for c in got.columns}
    assert normal(got) == normal(want)
