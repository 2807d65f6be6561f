"""Every query with SQL gives the rows of its SQL; the others give rows of a stable schema."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from chorale.plans.catalogue import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = db.sql(ORACLE_SQL[name])
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=str)
    found = sorted((tuple(plain(x) for x in r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=str)
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
