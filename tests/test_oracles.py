"""Every registered query with an oracle equals its DuckDB SQL at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["patient_id", "label"]
    assert df.count() == 150
