"""Every query of the catalogue against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from egolake import catalog, catalog_video  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def plain(v):
    if isinstance(v, float):
        return "null" if v != v else f"{v + 0.0:.6g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return "null" if v is None else f"{float(v):.6g}" if isinstance(v, int) and not isinstance(v, bool) else str(v)


def table(rows, cols):
    return sorted(tuple(plain(r[c]) for c in cols) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    got = __spark_entry__.queries()[name](spark, DATA)
    if name not in catalog.ORACLE_SQL:
        assert got.count() > 0
        return
    found = con.execute(catalog.ORACLE_SQL[name])
    cols = sorted(c[0] for c in found.description)
    assert sorted(got.columns) == cols
    names = [c[0] for c in found.description]
    assert table(got.collect(), cols) == table([dict(zip(names, r, strict=True)) for r in found.fetchall()], cols)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
