"""Every registered query outside the optional folder against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from orgmill.plans import queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLES[name])
    assert columns == sorted(want.columns)
    place = [want.columns.index(c) for c in columns]
    key = lambda row: tuple((x is not None, str(x)) for x in row)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key) == sorted((tuple(plain(r[i]) for i in place) for r in want.fetchall()), key=key)
