"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from brooklog.plans import registry

SF_DIR = "/root/testdata/sf0.001"


def canonical(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("nation", "orders", "lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    found = sorted(tuple(canonical(r[c]) for c in sorted(df.columns)) for r in df.collect())
    sql = duck.sql(registry.ORACLE_SQL[name])
    at = [sql.columns.index(c) for c in sorted(sql.columns)]
    assert sorted(df.columns) == sorted(sql.columns)
    assert found == sorted(tuple(canonical(r[k]) for k in at) for r in sql.fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
