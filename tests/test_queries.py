"""Every registered query of the library beside its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from gridspark.plans.registry import ORACLES, QUERIES
from gridspark.sources.fixtures import TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    made = duckdb.connect()
    for t in TABLES:
        made.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return made


def shown(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    out = db.sql(ORACLES[name])
    at = [out.columns.index(c) for c in columns]
    assert len(out.columns) == len(columns)
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in out.fetchall())
