"""Every registered query against its DuckDB SQL on a small scale factor, and the contract of the entry module."""

from __future__ import annotations

import datetime
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from galenus.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    res = duck.execute(registry.oracle_sql()[name])
    found = [c[0] for c in res.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_give_rows(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


def test_resolve_entity_reads_the_whole_table(spark, tmp_path):
    rows = [(8, "Customer#8", "BUILDING"), (9, "Customer#9", "MACHINERY"), (300, "Customer#300", "U8")]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    assert {r.substance_key for r in registry.queries()["resolve_entity"](spark, str(tmp_path)).collect()} == {8, 300}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_import_needs_no_session_and_no_optional_part(tmp_path):
    root = Path(entry.__file__).parent
    for p in (root / "__spark_entry__.py", root / "galenus"):
        (tmp_path / p.name).symlink_to(p)
    code = "import sys; sys.modules['galenus.llm'] = None; import __spark_entry__ as e; assert 'decontaminate' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_partitioning_does_not_change_results(spark, sf):
    from galenus.operators import curate
    from galenus.session import table

    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ids = [{r[0] for r in curate.contaminated_ids(docs.repartition(n), bench).collect()} for n in (1, 7)]
    assert ids[0] == ids[1]
