"""The training-data queries that have SQL, against DuckDB over whole small tables."""

from __future__ import annotations

import duckdb
import pytest

pytest.importorskip("galenus.llm")

from galenus.llm import queries  # noqa: E402

TABLES = ("documents", "benchmark", "pages", "labels")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    res = con.execute(queries.oracle_sql()[name])
    found = [c[0] for c in res.description]
    assert sorted(found) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*found).collect()), key=str) == sorted(res.fetchall(), key=str)
