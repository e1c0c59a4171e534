import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

CORE = [n for n in entry.core.QUERIES]


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if v == v else None
    if hasattr(v, "item"):
        v = v.item()
    return round(float(v), 6) if type(v).__name__ in ("float", "Decimal") else v


@pytest.mark.parametrize("name", CORE)
def test_query_matches_sql(spark, small, con, name):
    df = entry.core.QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=repr)
    if name not in entry.core_sql.SQL:
        assert got
        return
    rel = con.execute(entry.core_sql.SQL[name])
    names = [x[0] for x in rel.description]
    rows = rel.fetchall()
    assert sorted(names) == cols
    assert got == sorted(([plain(r[names.index(c)]) for c in cols] for r in rows), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.core.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
