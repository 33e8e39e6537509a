"""Every query against its SQL, over the two smallest sets of tables."""

import os

import duckdb
import pytest

from tagloom.plans import source_queries  # noqa: F401
from tagloom.plans.catalog_queries import ORACLE, QUERIES

DATA = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not all(map(os.path.isdir, DATA)), reason="needs the shared tables")


@pytest.fixture(scope="module", params=DATA, ids=lambda d: d.rsplit("/", 1)[-1])
def tables(request):
    c = duckdb.connect()
    for name in os.listdir(request.param):
        c.sql(f"create view {name.removesuffix('.parquet')} as select * from '{request.param}/{name}'")
    return request.param, c


def values(frame):
    plain = lambda v: float(v) if isinstance(v, int | float) and not isinstance(v, bool) else None if v is None else str(v)
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(map(plain, r))) for r in frame.where(frame.notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    path, db = tables
    got, want = QUERIES[name](spark, path).toPandas(), db.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got) == values(want)


def test_entry_works(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
