"""Signals, recalls, loads, graph, lookups, gates, audit and training data on hand-worked cases."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from galenus import schemas
from galenus.operators import articles, audit, gate, graph, load, lookups, quality, recall, sampling, signals, training
from galenus.operators.claims import Claim, LookupResult, Provenance

D = datetime.date


def signal_tables(spark, reports, drugs, reactions, cap=30):
    r = spark.createDataFrame(reports, "rid string, receive_date date")
    d = spark.createDataFrame(drugs, "rid string, entry_id int, role string, lot string")
    e = spark.createDataFrame(reactions or [("none", 0)], "rid string, term_id int")
    m = spark.createDataFrame([(1, 10), (2, 20), (3, 10), (4, 40)], "entry_id int, moiety int")  # 1 and 3 are a base and its salt
    terms = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "term_id int, term_norm string")
    return {k: sorted(map(tuple, v.collect()), key=str) for k, v in signals.rebuild(r, d, e, m, signals.canonical_terms(terms), cap).items()}


Q = D(2020, 1, 1)


def test_two_suspects_give_both_directions(spark):
    t = signal_tables(spark, [("r", D(2020, 2, 3))], [("r", 1, "suspect", None), ("r", 2, "suspect", "L1")], [])
    assert t["pair_quarter"] == [(10, 20, Q, 1, 1), (20, 10, Q, 1, 1)]
    assert t["batch_coverage"] == [(10, Q, 1, 0), (20, Q, 1, 1)] and t["batch_quarter"] == [(20, "L1", Q, 1)]


def test_salt_and_base_are_one_moiety(spark):
    t = signal_tables(spark, [("r", Q)], [("r", 1, "concomitant", "UNK"), ("r", 3, "suspect", "UNKONWN")], [])
    assert t["pair_quarter"] == [] and t["moiety_quarter"] == [(10, Q, 1, 1)] and t["batch_quarter"] == [] and t["batch_coverage"] == [(10, Q, 2, 0)]


def test_interacting_and_null_roles_are_not_suspect(spark):
    t = signal_tables(spark, [("r", Q)], [("r", 1, "interacting", None), ("r", 2, None, None)], [])
    assert t["moiety_quarter"] == [(10, Q, 0, 1), (20, Q, 0, 1)]


def test_cap_and_undated_reports(spark):
    drugs = [(r, e, "suspect", None) for r in ("big", "undated", "small") for e in ((1, 2, 4) if r == "big" else (1, 2))]
    t = signal_tables(spark, [("big", Q), ("undated", None), ("small", Q)], drugs, [("big", 1), ("big", 2), ("undated", 1)], cap=2)
    assert t["pair_quarter"] == [(10, 20, Q, 1, 1), (20, 10, Q, 1, 1)]
    assert t["quarter_totals"] == [(Q, 2, 2, 1, 1)] and t["moiety_quarter"] == [(10, Q, 2, 2), (20, Q, 2, 2), (40, Q, 1, 1)]
    assert t["event_quarter"] == [(10, 1, Q, 1, 1), (20, 1, Q, 1, 1), (40, 1, Q, 1, 1)] and t["term_quarter"] == [(1, Q, 1)]


def test_two_by_two(spark):
    reports = [(f"r{i}", Q) for i in range(6)]
    drugs = [(f"r{i}", 1 if i < 3 else 2, "suspect", None) for i in range(6)]
    t = signal_tables(spark, reports, drugs, [("r0", 1), ("r1", 1), ("r2", 3), ("r3", 1), ("r4", 3), ("r5", 3)])
    event = next(r for r in t["event_quarter"] if r[:2] == (10, 1))[4]
    moiety, term, total = next(r for r in t["moiety_quarter"] if r[0] == 10)[3], next(r for r in t["term_quarter"] if r[0] == 1)[2], t["quarter_totals"][0][1]
    a, b, c, d = event, moiety - event, term - event, total - moiety - term + event
    assert (a, b, c, d) == (2, 1, 1, 2) and (a / (a + b)) / (c / (c + d)) == 2.0 and (a * d) / (b * c) == 4.0


def test_bridge_keeps_all_hits_of_the_best_rank(spark):
    entries = spark.createDataFrame([(1, "brand", "x\\y;z", ["u9"]), (2, "brand", "x | y", None), (3, "brand", None, None), (4, None, None, None)], "entry_id int, product string, active string, uniis array<string>")
    xref = spark.createDataFrame([("unii", "U1", 1), ("name", "x", 2), ("name", "y", 3), ("name", "y", 4), ("name", "brand", 5)], "id_type string, id_value string, substance_key long")
    got = signals.bridge(signals.bridge_candidates(entries), xref)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 2), (1, 3, 2), (1, 4, 2), (2, 2, 2), (2, 3, 2), (2, 4, 2), (3, 5, 3)]
    assert [r.entry_id for r in signals.unbridged(entries, got).collect()] == [4]


def test_report_shaping(spark):
    schema = (
        "source_file string, report struct<safetyreportid:string,safetyreportversion:string,receivedate:string,receiptdate:string,serious:string,seriousnessdeath:string,seriousnesshospitalization:string,"
        "seriousnesslifethreatening:string,seriousnessdisabling:string,seriousnesscongenitalanomali:string,seriousnessother:string,occurcountry:string,primarysourcecountry:string,primarysource:struct<reportercountry:string>,"
        "patient:struct<patientsex:string,patientonsetage:string,patientonsetageunit:string,patientweight:string,"
        "drug:array<struct<drugcharacterization:string,medicinalproduct:string,drugbatchnumb:string,drugadministrationroute:string,drugindication:string,activesubstance:array<struct<activesubstancename:string>>,openfda:struct<unii:array<string>,substance_name:array<string>>>>,"
        "reaction:array<struct<reactionmeddrapt:string,reactionoutcome:string>>>>"
    )
    drug = ("1", " Asp ", "a-1", None, "pain", [("B",), ("A",), ("A",)], (["u2", "u1"], ["N"]))
    patient = ("1", "6", "802", "x", [drug, ("3", "Other", None, None, None, None, None)], [("Nausea", "1")])
    row = ("f", ("r1", "2", "20200230", "20200401", None, "1", None, None, None, None, None, None, "US", None, patient))
    reports, drugs, reactions = signals.shape_reports(spark.createDataFrame([row], schema))
    r = reports.head()
    assert (r.safetyreportid, r.version, r.receive_date, r.serious, r.serious_death, r.serious_other, r.country, r.weight_kg) == ("r1", 2, D(2020, 4, 1), True, True, False, "US", None) and abs(r.age_years - 0.5) < 1e-9
    d = drugs.orderBy("seq").collect()
    assert (d[0].role, d[0].active_substance, d[0].annotation, d[0].batch_norm) == ("suspect", "A; B", '{"substance_name":["N"],"unii":["u1","u2"]}', "A1")
    assert (d[1].role, d[1].active_substance, d[1].annotation) == ("interacting", "other", None) and reactions.head().term == "Nausea"


def test_recall_routes_and_matches(spark):
    recalls = spark.createDataFrame(
        [("r1", "x", "Lot A1234", ["own"], []), ("r2", "NDC 12345-678-90 y", "Lots B100 through B101", [], []), ("r3", "Aspirin acid, sold by Z", "no code", None, []), ("r4", "z", "Lot UNK", None, ["U1"])],
        "recall_number string, description string, code_info string, substance_names array<string>, uniis array<string>",
    )
    products = spark.createDataFrame([("123450678", "prod")], "product_key string, name string")
    subs = spark.createDataFrame([("U1", "coded")], "unii string, name string")
    known = spark.createDataFrame([("aspirin acid",), ("aspirin",), ("own",), ("prod",), ("coded",)], "name string")
    got = recall.recall_lots(recalls, products, subs, known, "2024").orderBy("recall_number", "lot_norm").collect()
    assert [(r.recall_number, r.substance_names, r.lot_norm, r.method, r.substance_method) for r in got] == [
        ("r1", ["own"], "A1234", "prefix", "openfda"), ("r2", ["prod"], "B100", "range", "ndc"), ("r2", ["prod"], "B101", "range", "ndc"), ("r3", ["aspirin acid"], None, "none", "product_text"), ("r4", ["coded"], None, "none", "openfda"),
    ]
    batches = spark.createDataFrame([("m", "B100", Q, 3), ("m", "B100", D(2021, 1, 1), 4), ("m", "UNK", Q, 9)], "moiety string, lot string, quarter date, reports long")
    names = spark.createDataFrame([("m", "prod")], "moiety string, name string")
    hits, counts = recall.lot_matches(spark.createDataFrame(got), batches, names)
    assert [tuple(r) for r in hits.collect()] == [("m", "r2", "B100", 7, Q, D(2021, 1, 1))] and counts.head().recalls == 4
    assert recall.lot_matches(spark.createDataFrame(got), batches.limit(0), names)[1].head().recalls == 4


def test_recall_routes_without_a_key_give_way(spark):
    rows = [("r1", "NDC 12345-678-90", "Lot A1234", ["keyless"], ["U1"]), ("r2", "NDC 99999-678-90 aspirin", None, ["keyless"], []), ("r3", "nothing", "Lot C9999", ["keyless"], []), ("r4", "nothing", None, ["keyless", "known too"], [])]
    recalls = spark.createDataFrame(rows, "recall_number string, description string, code_info string, substance_names array<string>, uniis array<string>")
    products = spark.createDataFrame([("123450678", "prod"), ("123450678", "other"), ("999990678", "keyless")], "product_key string, name string")
    subs = spark.createDataFrame([("U1", "coded")], "unii string, name string")
    known = spark.createDataFrame([("aspirin",), ("prod",), ("coded",), ("known too",)], "name string")
    lots = recall.recall_lots(recalls, products, subs, known, "1")
    got = {r.recall_number: (r.substance_names, r.substance_method) for r in lots.collect()}
    assert got == {"r1": (["other", "prod"], "ndc"), "r2": (["aspirin"], "product_text"), "r3": (None, None), "r4": (["keyless", "known too"], "openfda")}
    assert {tuple(r) for r in recall.recall_counts(lots).collect()} == {("ndc", 1, 1, 1), ("product_text", 1, 0, 0), ("none", 1, 1, 1), ("openfda", 1, 0, 0)}


def plain_parts(sizes, most_rows, most_bytes):
    out, part = [], []
    for n in sizes:
        if part and (len(part) == most_rows or sum(part) + n > most_bytes):
            out.append(part)
            part = []
        part.append(n)
    return [*out, part] if part else out


def test_parts_keep_both_caps(spark):
    sizes = {"x": [1000] * 6 + [0] * 500, "y": [10, 5000, 10, 990, 1], "z": [7] * 230, None: [1, None]}
    rows = [(b, i, n) for b, ns in sizes.items() for i, n in enumerate(ns)]
    got = load.part_numbers(spark.createDataFrame(rows, "b string, o int, n int").repartition(5), "b", "o", F.col("n"), 100, 1000).collect()
    for b, ns in sizes.items():
        parts = {}
        for r in sorted((r for r in got if r.b == b), key=lambda r: r.o):
            parts.setdefault(r.part, []).append(r.n or 0)
        assert [parts[k] for k in sorted(parts)] == plain_parts([n or 0 for n in ns], 100, 1000) and sorted(parts) == list(range(len(parts)))
    sliced = load.part_numbers(spark.createDataFrame(rows, "b string, o int, n int"), "b", "o", F.col("n"), 100, 1000, slice_rows=100).groupBy("b", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("bytes")).collect()
    assert all(r.rows <= 100 and ((r.bytes or 0) <= 1000 or r.rows == 1) for r in sliced) and sum(r.rows for r in sliced) == len(rows)
    assert len({r.part >> 32 for r in sliced if r.b == "x"}) > 1


def test_loads(spark):
    s = spark.createDataFrame([("1", "a", 1), ("2", "a", 1), ("3", "b", 1), ("9", "b", 1)], "id string, source_file string, v int")
    new = spark.createDataFrame([("1", "a", 2), ("3", "a", 2)], "id string, source_file string, v int")
    assert sorted(map(tuple, load.replace_source_file(s, new).collect())) == [("1", "a", 2), ("3", "a", 2), ("9", "b", 1)]
    assert load.delete_source_files(s, ["a"]).count() == 2
    with pytest.raises(ValueError):
        load.retire_source_files(s, [])
    reg = load.publish_release(load.publish_release(spark.createDataFrame([], schemas.RELEASE), "d", "1", 5, "f"), "d", "2", 6, "f")
    assert load.latest_release(reg, "d") == "2" and load.latest_release(reg, "x") is None and reg.filter("is_latest").count() == 1
    stored = spark.createDataFrame([("b", 5)], "k string, id long")
    grown = load.extend_dictionary(stored, spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "k string"), ["k"], "id")
    assert {r.k: r.id for r in grown.collect()} == {"b": 5, None: 6, "a": 7, "c": 8}
    parts = load.part_numbers(spark.createDataFrame([("x", i, 10) for i in range(5)] + [("y", 0, 99)], "b string, o int, n int"), "b", "o", F.col("n"), 2, 1000)
    assert [r.part for r in parts.filter("b = 'x'").orderBy("o").collect()] == [0, 0, 1, 1, 2]
    assert load.classify_pending(["a", "b", "c"], {"a", "b"}, {"a"}) == {"to_delete": ["a"], "done": ["c"], "waiting": ["b"]}


def test_generations_and_corpus_sink(spark, tmp_path):
    rows = spark.createDataFrame([("t", "s", 2020, "h2"), ("u", "s", 2020, "h1"), ("v", "q", 0, "h3")], "text string, source string, year int, content_hash string")
    load.write_corpus(rows, f"file://{tmp_path}/c")
    assert spark.read.parquet(f"file://{tmp_path}/c").count() == 3 and (tmp_path / "c" / "source=s" / "year=2020").exists()
    for g in ("1", "2"):
        rows.withColumn("g", F.lit(g)).write.parquet(f"file://{tmp_path}/g/generation={g}")
        load.swap_pointer(spark, f"file://{tmp_path}/g", g)
    assert {r.g for r in load.read_generation(spark, f"file://{tmp_path}/g").collect()} == {"2"}


def test_substances(spark):
    records = spark.createDataFrame([("U1", None, "U9", 1), ("U1", "salt", "U9", 2), ("U2", "base", "U2", 3)], "unii string, name string, moiety_unii string, seq long")
    got = {r.unii: r for r in load.substances(records, spark.createDataFrame([("U2", 4)], "unii string, substance_key long")).collect()}
    assert got["U2"].substance_key == 4 and got["U1"].name == "salt" and got["U9"].name is None and got["U1"].moiety_key == got["U9"].substance_key


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", None), ("c", "d")], "src string, dst string")
    got = graph.reachable(edges, spark.createDataFrame([("a",)], "node string"), 9)
    assert {(r.node, r.hop) for r in got.collect()} == {("b", 1), ("c", 2), ("d", 3)}
    trees = spark.createDataFrame([("D1", "C01"), ("D2", "C01.100"), ("D3", "C010.2"), ("D4", "D02.1")], "descriptor_ui string, tree_number string")
    assert {r[0] for r in graph.descendants(trees, "D1").collect()} == {"D1", "D2"}
    assert [tuple(r) for r in graph.hierarchy_edges(trees).collect()] == [("D2", "D1")]
    mesh = spark.createDataFrame([("1", "D2"), ("2", "D3"), ("3", "D011247")], "pmid string, descriptor_ui string")
    chem = spark.createDataFrame([("2", "D4"), ("2", "D9")], "pmid string, substance_ui string")
    assert {tuple(r) for r in graph.facets(mesh, trees, chem, graph.facet_rules(spark)).collect()} == {("1", "condition", "D2"), ("2", "condition", "D3"), ("3", "special_population", "D011247"), ("2", "drug", "D4")}
    cites = spark.createDataFrame([("a", "b"), ("b", None)], "src_pmid string, dst_pmid string")
    tables = {"cites": cites, "keywords": spark.createDataFrame([("a", "Heart")], "pmid string, keyword string")}
    assert [r.n for r in graph.neighbours(tables, "a", "cites", 3).collect()] == ["b"] and [r.n for r in graph.neighbours(tables, "b", "cited_by").collect()] == ["a"]
    assert [r.n for r in graph.neighbours(tables, "a", "keyword").collect()] == ["heart"]
    with pytest.raises(ValueError):
        graph.neighbours(tables, "a", "friends")


@pytest.fixture(scope="module")
def tables(spark):
    subs = spark.createDataFrame([(1, "U1", "Drug", "U1", 1), (2, "U2", "Drug salt", "U1", 1), (3, "U3", "Other", None, None)], schemas.SUBSTANCE)
    xref = spark.createDataFrame([(1, "name", "drug", "s"), (2, "name", "drug", "s"), (2, "name", "drug salt", "s")], schemas.SUBSTANCE_XREF)
    rec = lambda k, day, names, status: ("fda_enforcement", "r2", k, "US", names, None, day, f'{{"status":"{status}"}}', "f", 1)
    records = spark.createDataFrame([rec("a", D(2020, 5, 1), ["drug"], "Ongoing"), rec("b", None, ["drug salt"], "x"), rec("c", D(2019, 1, 1), ["drug"], "y"), rec("d", D(2020, 6, 1), ["other"], "z")], schemas.REG_RECORD)
    return {"substances": subs, "xref": xref, "records": records, "releases": spark.createDataFrame([("fda_enforcement", "r2", True, 4, "f")], schemas.RELEASE)}


def test_lookups(tables, spark):
    found = lookups.Lookups(tables)
    one, two = found.resolve_entity("U3"), found.resolve_entity("DRUG")
    assert one.claims[0].confidence == 1 and two.claims[0].method == "mapped" and two.claims[0].confidence == 0.5 and two.claims[0].value == "1" and two.claims[0].alternatives[0].value == "2"
    assert found.resolve_entity("nothing").coverage.missing == ("substance",) and not found.resolve_entity(" ").claims
    acts = found.call("safety_actions", {"key": 2, "start": "2020-01-01", "end": "2020-12-31", "tenant": "t"})
    assert [c.provenance.record_key for c in acts.claims] == ["a"] and acts.claims[0].value == "Ongoing" and "1 records with no date" in acts.coverage.notes[0]
    assert acts.coverage.missing == ("ema_referrals", "ema_dhpc", "ema_psusa") and LookupResult.from_json(acts.to_json()) == acts
    assert found.approval_status(99).coverage.notes == ("substance 99 not found",) and found.trials(1).coverage.missing == ("aact",) and found.current_label(1).coverage.missing == ("dailymed",)
    with pytest.raises(ValueError):
        Claim("x", None, "guessed", Provenance("s"))


def test_more_lookups(tables, spark):
    more = dict(tables)
    more["mesh"] = spark.createDataFrame([("9", "Drug", ["therapy"], "f"), ("10", "Drug", [], "f"), ("8", "Other", [], "f")], "pmid string, descriptor_name string, qualifiers array<string>, source_file string")
    more["articles"] = spark.createDataFrame([("x9", "pubmed", "9", 2020, None, "f"), ("dailymed:s", "dailymed", None, 2021, '{"version":"7"}', "g")], "id string, source string, pmid string, year int, book_meta string, source_file string")
    more["label_substances"] = spark.createDataFrame([("dailymed:s", "U2")], "article_id string, unii string")
    more["label_sections"] = spark.createDataFrame([("dailymed:s", "34067-9", "Uses", 0)], "article_id string, loinc_code string, title string, start_offset int")
    more["studies"] = spark.createDataFrame([("NCT1", "t", "done", "2")], "nct_id string, brief_title string, overall_status string, phase string")
    more["intervention_substance"] = spark.createDataFrame([("NCT1", 2), ("NCT1", 1)], "nct_id string, substance_key long")
    more["moiety_quarter"] = spark.createDataFrame([(1, D(2020, 4, 1), 2, 5)], "moiety long, quarter date, reports_suspect long, reports_any long")
    more["quarter_totals"] = spark.createDataFrame([(D(2020, 4, 1),)], "quarter date")
    more["codes"] = spark.createDataFrame([("ucum", "r", "mg", "milligram")], "system_key string, release_id string, code string, label string")
    found = lookups.Lookups(more)
    assert [c.value for c in found.literature(1).claims] == ["9", "10"] and [c.value for c in found.literature(1, "Therapy").claims] == ["9"]
    assert found.current_label(1).claims[0].provenance.release == "7" and len(found.trials(1).claims) == 1
    counts = found.report_counts(2, D(2020, 1, 1), D(2020, 6, 30))
    assert counts.claims[0].value == "5" and counts.coverage.notes == ("no data for 2020Q1",)
    assert found.lookup_code("ucum", "mg").claims[0].value == "milligram" and found.lookup_code("ucum", "x").coverage.missing == ("ucum",)


def test_gate():
    assert gate.evaluate({"rows": 5, "license_counts": {"CC0": 1, "x": 0}, "counts": {"a": 1}}, {"min_rows": 5, "allowed_licenses": ["CC0"], "min_counts": {"a": 1}}) == []
    fails = gate.evaluate({"duplicate_ids": 2, "null_pct": {}, "counts": {"a": None}}, {"max_duplicate_ids": 1, "min_rows": 1, "max_null_pct": {"c": 0}, "min_counts": {"a": 0}, "meta_total_equals_rows": True, "parts_within_caps": True})
    assert len(fails) == 6 and not any("max_null_pct" in f for f in fails)
    with pytest.raises(ValueError):
        gate.evaluate({}, {"max_dupes": 1})
    assert gate.input_set_problems([("2020q1", 1, 2), ("2020q3", 1, 1)]) == ["2020q1: part 2 of 2 is missing", "2020q2 is missing"]
    assert gate.part_gaps([1, 4]) == [2, 3] and gate.below_floor(5, 10, 0.9) and gate.orphan_breaches({"a": (1, 10), "b": (0, 0)}) == {"a": 0.1}


def test_audit_chain(spark):
    trail = spark.createDataFrame([], schemas.AUDIT)
    for n, e in enumerate(("run_start", "load_commit", "run_end")):
        trail = spark.createDataFrame(audit.append(trail, {"event_type": e, "actor": "a", "pid": n}).collect(), schemas.AUDIT)
    assert audit.verify(trail).count() == 0
    rows = [r.asDict() for r in trail.collect()]
    rows[1]["object"] = "changed"
    rows[2]["prev_hash"] = "0" * 64
    bad = spark.createDataFrame([tuple(r[c] for c in trail.columns) for r in rows], schemas.AUDIT)
    assert {(r.seq, r.problem) for r in audit.verify(bad, 2).collect()} == {(2, "hash_mismatch"), (3, "hash_mismatch"), (3, "chain_break"), (3, "mirror_short")}
    for wrong in ({"event_type": "x"}, {"event_type": "manual_correction"}):
        with pytest.raises(ValueError):
            audit.append(trail, wrong)


def test_training(spark):
    rows = spark.createDataFrame([(i, "s", "commercial" if i % 2 else "open_metadata", f"text {i % 7} words", None) for i in range(60)] + [(99, "bad", "commercial", "x", None)], "id long, source string, subset string, text string, content_hash string")
    kept, counts = training.build_slice(rows, 10_000, excluded=("bad",))
    assert {r.outcome: r["count"] for r in counts.collect()} == {"kept": 7, "duplicate": 23, "non_commercial": 30, "refused_excluded": 1} and kept.count() == 7
    again = training.build_slice(rows.repartition(5), 40, seed=3)[0]
    assert {r.id for r in again.collect()} == {r.id for r in training.build_slice(rows, 40, seed=3)[0].collect()}
    a, b = spark.range(6).withColumn("k", F.col("id")), spark.range(2).withColumn("k", F.col("id"))
    mixed = [r.stream for r in training.interleave(a, b, 0.75, "k").orderBy("place").collect()]
    assert mixed.count(0) == 6 and mixed[:4].count(1) == 1
    acc = training.accuracy(spark.createDataFrame([("A", "A"), ("B", "A"), (None, "A"), ("C", "C")], "predicted string, gold string")).head()
    assert (acc.total, acc.correct, acc.accuracy_pct) == (4, 2, 50.0)
    gated = spark.createDataFrame([("qa", "s", "commercial", None), ("qa", "bad", "commercial", None), ("tool_draft", "s", None, ["commercial", None]), ("tool_draft", "s", None, ["x"])], "k string, s string, u string, l array<string>")
    assert [r[0] for r in gated.select(training.licence_gate(F.col("k"), F.col("s"), F.col("u"), F.col("l"), ("bad",))).collect()] == [None, "excluded_source", "pending_licence", "non_commercial"]


def test_sampling(spark):
    units = spark.createDataFrame([("s", f"u{i}", i * 10, D(2020, 1, i + 1)) for i in range(5)], "source string, unit string, bytes long, stamp date")
    got = {r.which: r.unit for r in sampling.representative_units(units).collect()}
    assert got == {"largest": "u4", "smallest": "u0", "median": "u2", "newest": "u4", "oldest": "u0"}
    assert [r.position for r in sampling.with_position(spark.range(9).repartition(3), "id").orderBy("id").collect()] == list(range(1, 10))
    assert sampling.evenly_spaced(list(range(10)), 3) == [0, 3, 6] and [r.unit for r in sampling.nearest(units, "bytes", 19).collect()] == ["u2"]


def test_articles(spark):
    rows = articles.finalize(spark.createDataFrame([("a:1", "t", None, "CC BY 4.0"), (None, None, None, None)], "id string, title string, abstract string, license_raw string"))
    assert rows.columns == list(articles.article_types())
    r = rows.collect()
    assert (r[0].extract_status, r[0].license, r[0].subset, r[0].is_retracted, r[1].extract_status) == ("partial", "CC BY", "commercial", False, "dropped")
    hot, body = articles.split_hot_body(rows.filter("id is not null"))
    assert body.head().text_override is None and articles.join_hot_body(hot, body).head().text == "t"
    v = spark.createDataFrame([(1, "n", None, None, "r", "GRCh37"), (1, "m", None, None, "r", "GRCh38"), (None, "x", None, None, None, "NCBI36")], "variation_id long, name string, clinical_significance string, phenotype_list string, rcv_accession string, assembly string")
    got = articles.variant_articles(v, "f").collect()
    assert [(g.id, g.title, g.subset) for g in got] == [("clinvar:1", "m", "commercial")]
    with pytest.raises(Exception, match="not rising"):
        articles.increasing_or_raise(spark.createDataFrame([("f", 1, 5), ("f", 2, 5)], "source_file string, pos int, cid long"), "cid", "pos").count()
    ct = spark.createDataFrame([(1, "C1", "", "L", "V", None, "d", None)] + [(i, f"T{i}", "C1", "L", f"v{i}", None, None, "p") for i in range(2, 5)] + [(9, "T9", "C9", "", "v", None, None, None), (10, " ", "", "", "", None, None, None)],
                                "line long, code string, codelist_code string, name string, submission_value string, synonyms string, definition string, preferred_term string")
    parts, counters = articles.codelist_parts(ct, "SDTM", "2024", 2)
    assert [(p.id, p.n_terms, p.title) for p in parts.orderBy("id").collect()] == [("cdisc_ct:SDTM:C1:p1", 2, "L (part 1 of 2)"), ("cdisc_ct:SDTM:C1:p2", 1, "L (part 2 of 2)")]
    assert tuple(counters.head()) == (1, 1)


def test_quality(spark):
    rows = spark.createDataFrame([("1", "ab"), ("1", " "), (None, None)], "id string, text string")
    m = quality.measures(quality.shard_profile(rows))
    assert (m["rows"], m["duplicate_ids"], m["bytes_max"]) == (3, 1, 2) and abs(m["empty_text_pct"] - 66.6667) < 1e-3
    assert quality.coverage_pct(rows.select(F.col("id").alias("name")).limit(0), rows.select(F.col("id").alias("name"))).head().coverage_pct is None
    declared = spark.createDataFrame([("d", 2), ("e", 1)], "dataset string, total long")
    assert quality.declared_totals(spark.createDataFrame([("d",), ("d",)], "dataset string"), declared).head()[0] is False
