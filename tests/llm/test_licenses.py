"""Licence notices against the SQL over tables of real and made-up notices, at the threshold, wrapped, embedded and mixed up."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

pytest.importorskip("galenus.llm")

from galenus.llm import licenses  # noqa: E402
from galenus.llm.licence_texts import TEMPLATES  # noqa: E402


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in licenses.license_scan(docs).collect()}


def from_sql(texts):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": pd.array(texts, dtype="string")}))
    return con.execute(licenses.oracle()).fetchall()


def compare(spark, texts):
    got = {tuple(scan_row) for scan_row in scan(spark, texts).values()}
    assert got == set(from_sql(texts))


def test_size_bounds():
    for n in range(1, 200):
        reach = [a for a in range(1, 3 * n + 3) if 10 * min(a, n) >= 4 * (a + n)]  # Dice at least 0.8, in integers
        assert licenses.size_bounds(n, licenses.THRESHOLD) == (reach[0], reach[-1])


def test_each_template_finds_its_text(spark):
    wrapped = ["Some words before it.\n" + text.replace(" ", "\n * ", 3).replace(", ", ",\n") + " And words behind it" for _, text, _ in TEMPLATES]
    got = scan(spark, wrapped)
    assert [got[i].licenses for i in range(len(TEMPLATES))] == [name for name, _, _ in TEMPLATES]
    assert all(r.best_score == 1.0 and r.n_notices == 1 for r in got.values())


def test_versions_must_agree(spark):
    texts = [
        "This work is licensed under the GNU General Public License,\nversion 3.", "This work is licensed under the GNU General Public License, version 4.", "Licensed under the Apache License, Version 1.1.",
        "Licensed under the Apache License, Version 2.0. See the LICENSE file in the project root.", "Licensed under the terms of the Apache License, Version 2.0", "This work is licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 3.0.",
        "Licensed under the\nBSD 3-Clause License.", "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.",
    ]
    got = scan(spark, texts)
    assert [got[i].licenses for i in range(len(texts))] == ["GPL-3.0", "", "", "Apache-2.0", "Apache-2.0", "CC-BY-NC-4.0", "", "BSD-3-Clause", "CC-BY-4.0,CC-BY-SA-4.0"]
    assert got[3].spans == "Apache-2.0:0:7" and got[8].n_notices == 2
    compare(spark, texts)


def test_changed_notices_against_the_sql(spark):
    """Words dropped, put in and repeated, notices side by side, and plain text."""
    rng = random.Random(4)
    short = [t for t in TEMPLATES if len(t[1]) < 140]
    texts = [None, "", "license", "the license of the license of the license"]
    for i in range(120):
        words = []
        for _, text, _ in rng.sample(short if i % 3 else list(TEMPLATES), 2):
            own = text.split()
            for _ in range(rng.randint(0, max(1, len(own) // 6))):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[], [own[at], "other"], [own[at], own[at]], ["word"]])
                own = own or ["x"]
            words += own + rng.choice([[], ["and", "so"], ["licensed", "under"]])
        texts.append(rng.choice([" ", "\n", "\n\n * "]).join(words))
    compare(spark, texts)
    assert sum(r.n_notices for r in scan(spark, texts).values()) > 60


def test_sql_of_the_query(spark, sf):
    from galenus.llm import queries

    got = sorted(tuple(r) for r in queries.queries()["op2_licenses"](spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(con.execute(queries.oracle_sql()["op2_licenses"]).fetchall())


def test_long_text_of_notices(spark):
    import time

    began = time.time()
    got = scan(spark, ["Licensed under CC BY 4.0. " * 1500, "Released under the MIT License. " + "license of the work " * 5000])
    assert got[0].n_notices == 1500 and got[1].n_notices == 1 and time.time() - began < 60
