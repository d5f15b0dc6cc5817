"""Layer 1: every registered query against its DuckDB oracle on driver tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tools.catalog import ORACLE_SQL, QUERIES
from tools.oracle_check import TABLES, _digest, type_mismatches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    spark_types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    assert type_mismatches(spark_types, [(d[0], d[1]) for d in res.description]) == []
    assert len(rows) == len(o_rows)
    assert _digest(df.columns, rows) == _digest(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "user_email"]
