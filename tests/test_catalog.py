"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from dialstat.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    spark_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, spark_rows) == _canon(cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["id", "area", "name", "address", "sales_amount"]
    assert df.count() > 0
