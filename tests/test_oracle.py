"""Every registered query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from adlens.sources.tables import TEST_TABLES, table_path

SF = "/root/testdata/sf0.001"
# Spark type -> the DuckDB type name of the same values
DUCK_TYPE = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
             "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN", "DateType()": "DATE",
             "TimestampNTZType()": "TIMESTAMP"}
# the corpus operators have tests of their own
QUERIES = {k: f for k, f in queries().items() if f.__module__.startswith("adlens.plans")}
SQL = {k: q for k, q in oracle_sql().items() if k in QUERIES}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        if os.path.exists(table_path(SF, t)):
            con.execute(f"create view {t} as select * from read_parquet('{table_path(SF, t)}')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert canon(df.columns, s_rows) == canon(d_cols, d_rows)
    s_types = {f.name: DUCK_TYPE.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    d_types = {r[0]: r[1] for r in duck.execute(f"describe {SQL[name]}").fetchall()}
    assert s_types == d_types


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["name", "total_impressions", "total_clicks", "ctr"]
    assert df.count() >= 0
