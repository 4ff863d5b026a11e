"""Contract: entry() smoke and every SQL-checked query against DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if v is None:
        return "null"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["sector_cnae", "sexo", "media", "max", "std"]
    assert df.count() > 0


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())
