"""Every query against its SQL, on the smallest tables."""

import math
import os

import pytest

from loomspark.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v.is_integer() else round(v, 9)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([value(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())
