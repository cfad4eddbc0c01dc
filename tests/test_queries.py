"""Every query that has SQL gives the rows that DuckDB gives on the smallest tables."""

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from tidewright.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test data here")


def plain(v):
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else repr(round(float(v), 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "")
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in names]).collect())
    r = duck.execute(registry.oracle_sql()[name])
    at = [[d[0] for d in r.description].index(c) for c in names]
    want = Counter(tuple(plain(row[i]) for i in at) for row in r.fetchall())
    assert got == want


def test_every_query_without_sql_runs(spark):
    for name in registry.queries().keys() - registry.oracle_sql().keys():
        assert registry.queries()[name](spark, SF).count() >= 0
