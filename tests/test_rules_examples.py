"""Report rules, training examples, manifests, and the remaining sources."""

from __future__ import annotations

import json
import sqlite3
import zipfile
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from galenus.operators import examples, manifest, rules
from galenus.operators.claims import Claim, Coverage, LookupResult, Provenance
from galenus.sources import archives, documents, sqlite

SECTIONS = [
    rules.Section("s1", "1", "Introduction"), rules.Section("s2", "2", "Status", aliases=("Approval status",)), rules.Section("s6", "6.1", "Reference information", mah_data=True),
    rules.Section("a1", "Appendix 1", "Reference information", required=False), rules.Section("eu", "", "Regional", region="eu", required=False),
]


def test_section_rules():
    assert rules.check_sections(SECTIONS, ["1 Introduction", "2. Approval Status", "6.1 Reference information"]) == []
    found = [f.message for f in rules.check_sections(SECTIONS, ["2 Status", "1 Introduction", "1 Introduction", "Unknown", "Regional"])]
    assert found == ["duplicate section '1 Introduction'", "wrong order: section 1", "missing required section 6.1"]
    assert [i for i, _ in rules.match_headings(SECTIONS, ["Reference information", "Reference information", "Appendix 1 Reference information"])] == [2, 3, 3]
    bodies = {"6.1 Reference information": "MAH data required, or so"}
    assert not rules.check_markers(SECTIONS, bodies) and len(rules.check_markers(SECTIONS, bodies, strict=True)) == 1 and not rules.check_markers(SECTIONS, {"6.1 Reference information": ""}, frozenset({"s6"}))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=9))
def test_longest_rising(values):
    def best(i, last):
        return 0 if i == len(values) else max(best(i + 1, last), 1 + best(i + 1, values[i]) if values[i] > last else 0)

    keep = [values[i] for i in sorted(rules.longest_rising(values))]
    assert keep == sorted(set(keep)) and len(keep) == best(0, -1)


def test_headings_of_many_drafts(spark):
    drafts = spark.createDataFrame([(1, ["1 Introduction"]), (2, ["1 Introduction", "2 Status", "6.1 Reference information"])], "draft_id int, headings array<string>")
    assert {(r.draft_id, r.rule_id) for r in rules.heading_findings(drafts, SECTIONS).collect()} == {(1, "s2"), (1, "s6")}


def test_message_rules(spark, tmp_path):
    checks = [rules.FieldRule("id", ("head", "id"), True, r"[A-Z]{2}-\d+", 8), rules.FieldRule("day", ("day",), not_after_today=True), rules.FieldRule("kind", ("kind",), True, allowed=frozenset({"1"}))]
    today = date(2024, 1, 1)
    assert rules.check_message('<m><head><id extension="US-1"/></head><day value="20231231"/><kind code="1"/></m>', checks, today) == []
    found = [(f.rule_id, f.message.split(":")[0]) for f in rules.check_message('<m><head><id extension="US-123456x"/></head><day value="20240102"/></m>', checks, today)]
    assert found == [("id", "has a wrong form"), ("id", "is too long"), ("day", "lies in the future"), ("kind", "is missing")]
    (tmp_path / "a.xml").write_text("<broken")
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/a.xml")
    assert rules.message_findings(files, checks, today).head().rule_id == "xml"


def test_facts_and_skeleton():
    result = LookupResult((Claim("a fact", "1", "fetched", Provenance("s")),), Coverage(1, ("lost",), ("note",)))
    facts = rules.assemble_facts(lambda name, a: result, 1, date(2020, 1, 1), date(2020, 2, 1), {"s1": ("trials", "report_counts")})
    body = rules.skeleton(SECTIONS, facts)
    assert body["1 Introduction"] == "a fact\na fact\nnot available: lost\nnote" and body["6.1 Reference information"] == rules.MARKER and "Regional" not in body


def test_examples():
    checker = examples.Checker(frozenset({"trials"}), lambda doc, region: [rules.Finding("s1", "c", "m")], {"eu": ("16.2 Signal evaluation",)})
    ok = examples.parse_reply("grounded", {"passage": "x  said 12 things", "passage_ref": "r1"}, '{"question": "q", "answer": "\\"said 12\\" [r1]"}')
    assert checker.run(ok) == [] and ok.to_chat()[0]["content"].startswith("Passage [r1]:")
    curly = examples.Example("grounded", {**ok.fields, "answer": "“x said” and “12 things” [r1]"})
    assert checker.run(curly) == []
    bad = examples.Example("grounded", {**ok.fields, "answer": '"never" in 2019'})
    assert [r for r, _ in checker.run(bad)] == ["citation", "citation", "exact_values"]
    assert checker.run(examples.Example("grounded", {**ok.fields, "answer": "no quote [r1]"})) == [("citation", "answer has no quoted span")]
    draft = examples.Example("tool_draft", {"task": "t", "answer": "a", "tool_calls": [{"name": "x"}, {"name": "trials", "arguments": []}], "tool_results": []})
    assert [w for _, w in checker.run(draft)] == ["2 tool calls but 0 results", "unknown tool 'x'", "the arguments of trials are no object"]
    check = examples.Example("rule_check", {"document": {"h": "b"}, "findings": []})
    assert checker.run(check) == [("structure", "missed ('s1', 'c')")]
    told = [{"rule_id": "s1", "clause": "c", "message": "m"}, {"rule_id": "s2", "clause": "c", "message": "m"}]
    assert checker.run(examples.Example("rule_check", {"document": {"h": "b"}, "findings": told})) == [("structure", "not raised ('s2', 'c')")]
    assert checker.run(examples.Example("rule_check", {"document": {"h": 1}, "findings": [{"rule_id": ""}], "region": "x"}))[0] == ("format", "unknown region 'x'")
    assert checker.run(examples.Example("abstain", {"question": "q", "reason": "tired"}))[0][0] == "format"
    for raw in ('{"question": "a", "question": "b"}', "[]", '{"question": ""}'):
        with pytest.raises(ValueError):
            examples.parse_reply("grounded", {"passage": "p", "passage_ref": "r"}, raw)
    assert {t["function"]["name"] for t in examples.tool_schemas()} >= {"trials", "lookup_code"}


def test_report_drafts():
    silent = examples.Checker(frozenset(), lambda doc, region: [], {"eu": ("16 Signal evaluation",)})
    strict = examples.Checker(frozenset(), lambda doc, region: [rules.Finding("s1", region, "must say so")] if "1" not in doc else [])
    report = lambda answer, **f: examples.Example("tool_draft", {"task": "t", "answer": answer, "report_region": "eu", **f})
    assert silent.run(report('{"Signals": "see section 16"}')) == [] and silent.run(report('{"Signals": "see 17"}')) == [("exact_values", "17")]
    assert silent.run(report('{"99": "none"}')) == []  # headings state nothing
    assert silent.run(report('{"1": "in 2019"}')) == [("exact_values", "2019")]
    for answer in ("text", '{"1": "a", "1": "b"}', '{"1": 2}', "{}"):
        assert silent.run(report(answer)) == [("format", "the draft is no object of heading to body")]
    assert strict.run(report('{"2": "x"}')) == [("structure", "s1 (eu): must say so")]
    assert silent.run(report('{"1": "x"}', report_region="mars")) == [("format", "unknown region 'mars'")]


def test_claims_are_routed(spark):
    texts = ["Was Aspirin recalled? A recall is known", "Aspirin helps", "A trial of nothing", "NCT01234567 is in phase 2", "the label and recalls of ASPIRIN", None, "", "reports about Label"]
    claims = spark.createDataFrame(list(enumerate(texts)), "claim_id int, claim string")
    names = spark.createDataFrame([("Aspirin",), ("aspirin",), ("NCT01234567",), ("label",), (None,)], "name string")
    got = {r.claim_id: (r.route, r.function) for r in examples.route_claims(claims, names).collect()}
    assert got == {0: ("lookup", "safety_actions"), 1: ("model", None), 2: ("model", None), 3: ("lookup", "trials"), 4: ("lookup", "safety_actions"), 5: ("model", None), 6: ("model", None), 7: ("model", None)}
    cut = examples.route_claims(spark.createDataFrame([(1, "recall of alpha beta gamma Aspirin")], "claim_id int, claim string"), names, most=3)
    assert cut.head().route == "model"


def test_ledger(spark):
    rows, done = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("b",), ("b",)], "id string")
    assert [r.id for r in examples.pending(rows, done, "id").collect()] == ["a"]


def test_manifests(spark, tmp_path):
    parts = {"kind": "slice", "inputs": [{"p": 2}, {"p": 1}], "counts": {"n": 1}, "config": {"b": 1, "a": 2}}
    assert manifest.write_manifest(str(tmp_path / "m.json"), **parts) == manifest.manifest(**{**parts, "config": {"a": 2, "b": 1}})["config_sha256"]
    assert manifest.catalogue("s", {"t": spark.range(1)})["tables"][0]["columns"] == [{"name": "id", "dataType": "BIGINT", "nullable": False}]


def test_sqlite_tables(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "a.db")
    con.execute("create table act (activity_id integer primary key, v real, t text)")
    con.executemany("insert into act values (?, ?, ?)", [(i, i / 2, None if i % 3 else f"x{i}") for i in range(1, 26)])
    con.commit()
    con.close()
    df = sqlite.read_sqlite(spark, f"{tmp_path}/a.db", "act", rows=10)
    assert df.dtypes == [("activity_id", "bigint"), ("v", "double"), ("t", "string")] and df.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in df.collect())[2] == (3, 1.5, "x3") and df.count() == 25


def test_code_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        z.writestr("Table/codes.csv", '"NUM","NAME"\n"1-8","A, b"\n"2-6","C\nd"\n')
    got = archives.read_code_zip(spark, f"file://{tmp_path}/l.zip", "codes.csv", "loinc", "NUM", "NAME")
    assert {(r.code, r.label) for r in got.collect()} == {("1-8", "A, b"), ("2-6", "C\nd")}
    (tmp_path / "e.json").write_text('{"content": [{"code": "T1", "english": "Tablet"}, {"english": "none"}]}')
    assert [tuple(r) for r in archives.read_code_json(spark, f"file://{tmp_path}/e.json", "edqm").collect()] == [("edqm", "T1", "Tablet")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(-9, 10**6), st.text(max_size=8), st.dictionaries(st.text(max_size=3), st.lists(st.integers(), max_size=3), max_size=3), st.none(), st.booleans(), st.floats(allow_nan=False, allow_infinity=False)), max_size=12), st.integers(1, 40), st.booleans(), st.integers(0, 3))
def test_items_of_an_array_in_pieces(items, size, bare, more):
    text = json.dumps({"meta": {"n": 1}, **({"other": [1, 2]} if more else {}), "results": items, **({"tail": ["x"] * more} if not bare else {})}, indent=more or None)
    got = list(archives.array_items((text[i : i + size] for i in range(0, len(text), size)), "results"))
    assert [json.loads(x) for x in got] == items
    with pytest.raises(ValueError):
        list(archives.array_items(iter(['{"results": [1, 2']), "results"))


def test_documents_are_streamed(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"results": [{"k": i, "v": "x" * i} for i in range(1200)]}))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("c.json", json.dumps({"results": [{"k": -1}]}))
    got = archives.stream_json_items(spark, f"file://{tmp_path}/*", "k int, v string")
    assert got.count() == 1201 and got.filter("item.k = 1199 and length(item.v) = 1199").count() == 1 and got.filter("source_file like '%b.zip!c.json'").count() == 1


def test_sparse_row_ids_make_few_partitions(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "s.db")
    con.execute("create table t (id integer primary key, v text)")
    con.executemany("insert into t values (?, ?)", [(1, "a"), (10**12, "b")])
    con.commit()
    con.close()
    reader = sqlite.TableReader(f"{tmp_path}/s.db", "t", 10)
    parts = reader.partitions()
    assert len(parts) <= sqlite.MAX_PARTITIONS + 1 and sum(b.num_rows for p in (parts[0], parts[-1]) for b in reader.read(p)) == 2


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([("1", "epar", "https://x/a", 2, 1), ("1", "epar", "https://x/b", 2, 0), ("z", "epar", "https://x/c", 1, 2), ("2", "other", "https://x/d", 1, 3), ("3", "epar", "http://y", 1, 4)], "id string, type string, url string, last_updated int, position int")
    kept, refused = documents.select_documents(rows, ("epar",), "https://x/")
    assert kept.count() == 2 and {r.reason: r["count"] for r in refused.collect()} == {"id": 1, "type": 1, "url": 1}
    assert [r.url for r in documents.newest_documents(kept).collect()] == ["https://x/b"]
    (tmp_path / "a.pdf").write_bytes(b"%PDF broken")
    assert documents.pdf_text(spark.read.format("binaryFile").load(f"file://{tmp_path}/a.pdf")).head().error
