"""Every registered query against its DuckDB oracle (row count, columns, values) at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
# Spark simple type name -> DuckDB type name.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns
        return
    rel = con.sql(ORACLES[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == duck_types
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "country_trends" in df.columns
