"""Column functions on probe tables."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galenus.functions import answers, dates, ids, json, licences, lots, markup, sentences, text


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_licence_arms(spark):
    cases = {
        None: "unknown", " ": "unknown", "CC0 1.0": "CC0", "cc by-nc-nd 4.0": "CC BY-NC-ND", "CC BY NC": "CC BY", "CC BY-NC-SA": "CC BY-NC-SA", "cc-by-nc": "CC BY-NC", "CC BY-SA 3.0": "CC BY-SA",
        "https://creativecommons.org/licenses/by/4.0/.": "CC BY", "http://creativecommons.org/publicdomain/zero/1.0/": "CC0", "fair use only": "text_mining", "Apache License, Version 2.0.": "permissive",
        "MIT Technology Review": "unknown", "[BSD-3-Clause]": "permissive",
    }
    assert column(spark, list(cases), licences.licence_code) == list(cases.values())
    assert column(spark, ["see https://creativecommons.org/licenses/by/4.0/."], licences.licence_url) == ["https://creativecommons.org/licenses/by/4.0/"]
    assert column(spark, ["CC0", "CC BY-NC-ND", "public_domain", "text_mining", "unknown"], licences.subset_of) == ["commercial", "text_mining", "commercial", "text_mining", "open_metadata"]


def test_codes(spark):
    assert column(spark, ["1234-5678-9", "12345-678-90", " 00012345678 ", "1234567890", "x", None], ids.norm_ndc) == ["01234567809", "12345067890", "00012345678", None, None, None]
    assert column(spark, ["12-34", "12345-678-90", "123456789", "12"], ids.norm_ndc_product) == ["000120034", "123450678", "123456789", None]
    assert column(spark, ["NDA 020-123", "ANDA076543", "bla 1", "NDA12A"], ids.norm_application_number) == ["020123", "076543", "1", None]
    assert column(spark, ["12-34", "NDA 1x", "EMEA/H/C/1", " "], ids.norm_product_key) == ["000120034", "NDA 1x", "EMEA/H/C/1", None]
    assert column(spark, ["ab-12.3", "--", None], ids.norm_lot) == ["AB123", None, None]
    assert column(spark, ["UNK", "A1", None], ids.is_real_lot) == [False, True, False]
    assert column(spark, ["https://DOI.org/10.1/AbC", "10.1/x", ""], ids.bare_doi) == ["10.1/abc", "10.1/x", None]
    assert column(spark, ["https://pubmed.ncbi.nlm.nih.gov/0012/", "007", "https://x.org/12", "000"], ids.bare_pmid) == ["12", "7", None, None]
    assert column(spark, ["https://www.ncbi.nlm.nih.gov/pmc/articles/PMC012/", "55", "x"], ids.bare_pmcid) == ["PMC12", "PMC55", None]
    orcids = column(spark, ["https://orcid.org/0000-0002-1825-0097", "0000000218250097", "12"], ids.normalize_orcid)
    assert orcids == ["0000-0002-1825-0097"] * 2 + [None]
    assert column(spark, ["0000-0002-1825-0097", "0000-0002-1694-233X", "0000-0002-1825-0098", "x"], ids.orcid_check_ok) == [True, True, False, False]
    assert column(spark, ["ﬁsh  OIL\t", "Straße"], ids.norm_name) == ["fish oil", "strasse"]
    assert column(spark, ["a | b;; c "], ids.split_names) == [["a", "b", "c"]]
    ranks = column(spark, ["1.10", "1.9", "1.x"], ids.version_rank)
    assert sorted(range(3), key=lambda i: [tuple(p) for p in ranks[i]]) == [2, 1, 0]


def test_dates_and_numbers(spark):
    d = datetime.date
    assert column(spark, ["2020-02-30", "2020-02-29T10:00", "20200229", "3/4/2020", "soon"], dates.parse_date) == [None, d(2020, 2, 29), d(2020, 2, 29), d(2020, 4, 3), None]
    assert column(spark, ["3/4/2020"], lambda c: dates.parse_date(c, "mdy")) == [d(2020, 3, 4)]
    assert column(spark, [d(2021, 1, 3), d(2020, 12, 31)], lambda c: dates.release_id(c, "weekly"), "date") == ["2020-W53", "2020-W53"]
    assert column(spark, [d(2024, 2, 29)], lambda c: dates.interval_before(c)["start"], "date") == [d(2023, 2, 28)]
    assert column(spark, ["12", "-1", "1e9", "nan", "x"], dates.measure) == [12.0, None, None, None, None]
    assert column(spark, ["6"], lambda c: F.round(dates.age_years(c, F.lit("802")), 6)) == [0.5]


@pytest.mark.parametrize("value", [0.0, 12.0, 0.1, 1234567.0, 123456.0, 0.0001, 0.00001234, 999999.5, 5.5, 1e21, -2.50, 100000.0])
def test_general_number(spark, value):
    assert column(spark, [value], sentences.general_number, "double") == [f"{value:g}"]


def test_text(spark):
    assert column(spark, [" a\0b \t c\n\n\n\nd ", " x"], text.normalize_whitespace) == ["a b c\n\nd", "x"]
    long = "é" * 1500
    capped = column(spark, [long, "short"], text.cap_element)
    assert capped[1] == "short" and len(capped[0].encode()) <= 2000 and capped[0].endswith("…") and capped[0][:-1] == "é" * 998
    assert column(spark, [None, "", "abc"], text.content_hash)[:2] == [None, None]
    probes = [("t", None), ("", "a"), ("x" * 200, None), ("", None)]
    df = spark.createDataFrame(probes, "t string, a string")
    got = [r.s.status for r in df.select(text.extract_status(F.col("t"), F.col("a"), F.lit(None), F.lit(False)).alias("s")).collect()]
    assert got == ["partial", "ok", "ok", "dropped"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*(st.sampled_from([None, "", " \n", "A", "b c"]) for _ in range(3)), st.sampled_from([None, "", "A", "A\n\nb c", "other"])), min_size=1, max_size=20))
def test_override_restores_the_text(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, t string")
    parts = [F.col(x) for x in "abc"]
    back = df.select("t", text.virtual_text(text.text_override(F.col("t"), *parts), *parts).alias("v")).collect()
    assert all((r.v or None) == (r.t or None) for r in back)


LOTS = [
    ("Lot # AB123, AB124; Exp 12/25", [("AB123", "prefix"), ("AB124", "prefix")]), ("Lots: 12345 through 12348", [(str(n), "range") for n in range(12345, 12349)]), ("Lot A001-A003", [("A001", "range"), ("A002", "range"), ("A003", "range")]),
    ("All lots within expiry 2020", []), ("Batch No. 9781 500 mg", [("9781", "prefix")]), ("Lot 37-888833", [("37-888833", "prefix")]), ("NDC 12345-678-90", []), ("Lot: 1234A/5678B exp. JAN 2024", [("1234A", "prefix"), ("5678B", "prefix")]),
    ("Lot unknown, see label 12345", []), ("", []), (None, []), ("lots 020917L and 020918L", [("020917L", "prefix"), ("020918L", "prefix")]),
]


@pytest.mark.parametrize(("info", "want"), LOTS)
def test_lots(info, want):
    assert [(a, m) for a, _, m in lots.lots_in(info)] == want


def test_names_in_text(spark):
    assert column(spark, ["NDC 1234-5678-90 and NDC: 00012345678"], lots.ndc_products) == [["012345678", "000123456"]]
    words = column(spark, ["Metformin hydrochloride/Water tablets, Manufactured by: Acme water"], lots.name_words)
    assert words == [["Metformin", "hydrochloride", "Water", "tablets"]]
    known = [(0, 2, "metformin hydrochloride"), (1, 1, "hydrochloride"), (2, 1, "water")]
    df = spark.createDataFrame([([*known],)], "g array<struct<pos:int,n:int,gram:string>>")
    assert df.select(lots.pick_names(F.col("g"))).head()[0] == ["metformin hydrochloride"]


def test_answers(spark):
    assert column(spark, ["The answer is (B). Option c", "I say d.", "none", None], answers.choice_letter) == ["C", "D", "A", "A"]
    assert column(spark, ["Yes, no", "no idea", "maybe"], answers.yes_no_maybe) == ["yes", "no", "maybe"]
    assert answers.unstated("On 25 January 2020 there were 12 and 99 cases of NCT12345678", ["2020-01-25 with 12", "03/04/2020"]) == ["99", "NCT12345678"]
    assert answers.unstated("in 2015-2020 and 03/04/2020", ["4 March 2020", "2015", "2020"]) == ["2015", "2020"] or answers.unstated("03/04/2020", ["4 March 2020"]) == []
    assert column(spark, ['{"a": 1, "a": 2}', '{"a": 1}', "x"], answers.is_strict_json) == [False, True, False]
    df = spark.createDataFrame([('It says "a  b" [r1]', "x a b y", "r1"), ("no quote [r1]", "x", "r1"), ('"z" [r1]', "x", "r1"), ('"x"', "x", "r1")], "a string, p string, r string")
    got = [r[0] for r in df.select(answers.citation_problem(F.col("a"), F.col("p"), F.col("r"))).collect()]
    assert got[0] is None and all(got[1:])


LABEL = """<document xmlns="urn:hl7-org:v3"><setId root="s1"/><versionNumber value="3"/><component><structuredBody><component><section><code code="34067-9" codeSystem="2.16.840.1.113883.6.1"/><title>USES</title>
<text><paragraph>For  pain</paragraph><table><tr><td>a</td><td>b</td></tr></table></text><component><section><text>inner</text></section></component></section></component></structuredBody></component></document>"""


def test_label_markup():
    d = markup.parse_label(LABEL)
    assert d["body"] == "USES\nFor pain\na | b\n\ninner" and d["version"] == "3"
    s = d["sections"][0]
    assert d["body"][s["start"] : s["end"]] == d["body"] and s["loinc"] == "34067-9"
    with pytest.raises(ValueError):
        markup.safe_xml("<!DOCTYPE x [<!ENTITY a 'b'>]><x>&a;</x>")


def test_summary_sections():
    body = "ANNEX I\nSUMMARY OF PRODUCT CHARACTERISTICS\n1. NAME OF THE MEDICINAL PRODUCT\nDrugX 5 mg\n4. CLINICAL PARTICULARS\n4.1\nTherapeutic indications\nPain.\n4.3 Contraindications\nNone (see\n4.4 Warnings and use).\n5. PHARMACOLOGICAL PROPERTIES\n5.1 Pharmacodynamic properties\nText\nANNEX II\n6.1 List"
    got = markup.summary_sections(body)
    assert [(r["loinc_code"], r["title"]) for r in got] == [("34067-9", "4.1 Therapeutic indications"), ("34070-3", "4.3 Contraindications"), ("43679-0", "5.1 Pharmacodynamic properties")]
    assert body[got[0]["start_offset"] : got[0]["end_offset"]].endswith("Pain.") and got[0]["product"] == "DrugX 5 mg"
    assert markup.summary_sections(None) == []


def test_json(spark):
    assert column(spark, ['{"a":{"b":["x"," y ","x"]}}', '{"a":{}}', None], lambda c: json.payload_values(c, "a.b")) == [["x", "y"], [], []]
    assert column(spark, [{"a": [0, 2], "b": [1]}, None], json.inverted_index_text, "map<string,array<int>>") == ["a b a", None]


def test_sentences(spark):
    one = spark.range(1)
    n = F.lit(None).cast("string")
    s = lambda c: one.select(c).head()[0]
    assert s(sentences.compound(F.lit(1), F.lit("C"), F.lit("x"), n, F.lit("H2"))) == "PubChem compound CID 1 has IUPAC name x, molecular formula H2, and canonical SMILES C, as catalogued in the NCBI PubChem Compound database."
    assert s(sentences.compound(F.lit(1), n, n, F.lit("T"), n)) == "PubChem compound CID 1 (T), as catalogued in the NCBI PubChem Compound database."
    assert s(sentences.variant(F.lit(7), n, F.lit("benign"), n, F.lit("R1"))) == "ClinVar variation 7 is classified benign, per ClinVar accession R1, as catalogued in the NCBI ClinVar database."
    assert s(sentences.pathway(F.lit("P"), F.lit("H"), F.lit("S."), F.lit("A, B"), F.lit(9))).startswith("Reactome pathway P (H). S. Known protein participants include A, B, among 9 annotated in total.")
    assert s(sentences.term(F.lit("n"), F.lit("d"))) == "n: d" and s(sentences.descriptor(F.lit("D"), n)).startswith("D. As defined")
