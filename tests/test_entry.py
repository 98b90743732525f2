import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(canon, v))
    return str(v)[:26] if hasattr(v, "isoformat") else v


def test_flagship(spark, sf):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_against_sql(spark, sf, name):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = [tuple(canon(r[k]) for k in cols) for r in df.collect()]
    r = c.execute(entry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = [tuple(canon(x[names.index(k)]) for k in cols) for x in r.fetchall()]
    order = lambda x: tuple((y is None, str(y)) for y in x)
    assert sorted(got, key=order) == sorted(want, key=order)
