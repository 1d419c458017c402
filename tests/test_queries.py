"""Every query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

from tidemark import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, con, name):
    got = catalog.queries()[name](spark, sf)
    if name not in catalog.oracle_sql():
        assert got.count() > 0
        return
    want = con.sql(catalog.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda x: sorted(tuple(map(plain, r)) for r in x)
    assert rows(got.select(*columns).collect()) == rows(want.select(*columns).fetchall())
