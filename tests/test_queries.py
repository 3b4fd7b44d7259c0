"""Every query with SQL against DuckDB, on the smallest given tables."""

import os

import duckdb
import pytest

from cellstream.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[:-8] for f in os.listdir(SF) if f.endswith(".parquet")] if os.path.isdir(SF) else []
pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    found = duck.execute(registry.oracle_sql()[name])
    order = [[d[0] for d in found.description].index(c) for c in columns]
    want = sorted([plain(r[i]) for i in order] for r in found.fetchall())
    assert sorted([plain(v) for v in r] for r in got.select(*columns).collect()) == want
