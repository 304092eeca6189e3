"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import os

import pytest

from spanloom.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    own = frame[sorted(frame.columns)].astype(object)
    return [tuple(None if x != x else x for x in r) for r in own.itertuples(index=False)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    import duckdb

    got = QUERIES[name](spark, DATA).toPandas()
    if name not in SQL:
        assert len(got)
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(want)))
