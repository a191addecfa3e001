"""Every query of the library against its SQL, both over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from dispatchlake.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: "NULL" if v is None or v is pd.NaT or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    values = [tuple(r) for r in got.collect()]
    if name not in catalog.ORACLE_SQL:
        assert values
        return
    want = db.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, values) == rows(names, want.fetchall())


def test_flagship_is_registered():
    assert catalog.FLAGSHIP in catalog.QUERIES
