"""Every query of the library that has an oracle, against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from playmill.plans import probes
from playmill.plans.probes_basic import NAMES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for n in NAMES:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{small}/{n}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(probes.ORACLES))
def test_oracle(spark, duck, small, name):
    df = probes.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    relation = duck.sql(probes.ORACLES[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in relation.fetchall())
    assert got == want
