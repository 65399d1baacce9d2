"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def rows(found):
    flat = [tuple(float(f"{v:.10g}") if isinstance(v, float) and math.isfinite(v) else v for v in r) for r in found]
    return sorted(flat, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = rows(df.select(*columns).collect())
    assert got
    if name not in entry.oracle_sql():
        return
    cursor = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == rows(tuple(r[i] for i in at) for r in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["domain", "depth", "status", "urls"]
