"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from tallyline.plans import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    return round(float(v), 6) if isinstance(v, float) or v.__class__.__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, name):
    got = registry.queries()[name](spark, DATA)
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for f in Path(DATA).iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    want = con.execute(registry.oracles()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    a = sorted(repr([plain(r[c]) for c in order]) for r in got.collect())
    b = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in want.fetchall())
    assert a == b
