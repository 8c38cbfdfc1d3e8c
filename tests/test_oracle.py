"""Every registered query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from curatio.sources.testtables import TABLES

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "array<string>": "VARCHAR[]"}
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    srows = [tuple(norm(x) for x in r) for r in df.collect()]
    if name not in ORACLES:
        assert len(srows) > 0
        return
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    for col, t in df.dtypes:
        assert dtypes[col] == SPARK_TO_DUCK.get(t, t), f"{col}: spark {t} vs duckdb {dtypes[col]}"
    so = sorted(range(len(cols)), key=lambda i: cols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = Counter(tuple(r[i] for i in so) for r in srows)
    b = Counter(tuple(norm(r[i]) for i in do) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
