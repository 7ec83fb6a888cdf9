"""One small file of our own per format."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from galenus.operators import articles, gate
from galenus.sources import archives, books, bulk, feeds, files, substances, tables, texts, xml

RECORD = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">11</PMID><Article><Journal><Title>J Test</Title><JournalIssue><PubDate><MedlineDate>1998 Dec-1999 Jan</MedlineDate></PubDate></JournalIssue></Journal>
<ArticleTitle>A title</ArticleTitle><Abstract><AbstractText Label="AIM">To test.</AbstractText><AbstractText>More.</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><ForeName>Jo</ForeName>
<Identifier Source="ORCID">https://orcid.org/0000-0002-1825-0097</Identifier></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList><Language>eng</Language></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="N">Heart</DescriptorName><QualifierName UI="Q1" MajorTopicYN="Y">surgery</QualifierName></MeshHeading></MeshHeadingList>
<ChemicalList><Chemical><RegistryNumber>0</RegistryNumber><NameOfSubstance UI="D9">Stuff</NameOfSubstance></Chemical></ChemicalList><KeywordList Owner="NOTNLM"><Keyword MajorTopicYN="Y">Key</Keyword></KeywordList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/x</ArticleId><ArticleId IdType="pmc">PMC5</ArticleId></ArticleIdList><ReferenceList><Reference><Citation>Ref</Citation><ArticleIdList><ArticleId IdType="pubmed">7</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>"""


def test_literature(spark, tmp_path):
    with gzip.open(tmp_path / "a.xml.gz", "wt") as f:
        f.write(RECORD)
    records = xml.read_literature(spark, f"file://{tmp_path}/a.xml.gz").cache()
    r = xml.literature_articles(records).head()
    assert (r.pmid, r.doi, r.pmcid, r.year, r.abstract, r.authors, r.mesh, r.language) == ("11", "10.1/x", "PMC5", 1998, "AIM: To test.\nMore.", ["Jo Doe", "Group"], ["Heart"], "eng")
    e = {k: v.collect() for k, v in xml.literature_edges(records).items()}
    assert e["mesh"][0].major_topic and e["mesh"][0].qualifiers == ["surgery"] and e["cites"][0].dst_pmid == "7" and e["chemicals"][0].registry_number is None
    assert e["keywords"][0].keyword == "Key" and e["authors"][0].orcid == "0000-0002-1825-0097" and e["authors"][1].position == 2
    assert articles.finalize(xml.literature_articles(records)).head().extract_status == "ok"


def test_vocabularies(spark, tmp_path):
    (tmp_path / "d.xml").write_text(
        "<S><DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>Heart</String></DescriptorName><TreeNumberList><TreeNumber>A07.1</TreeNumber><TreeNumber>A08</TreeNumber></TreeNumberList>"
        '<ConceptList><Concept PreferredConceptYN="N"><ScopeNote>no</ScopeNote></Concept><Concept PreferredConceptYN="Y"><ScopeNote> The organ. </ScopeNote></Concept></ConceptList></DescriptorRecord></S>'
    )
    d, t = xml.read_descriptors(spark, f"file://{tmp_path}/d.xml")
    assert tuple(d.head()) == ("D1", "Heart", "The organ.") and t.count() == 2
    (tmp_path / "o.obo").write_text('format-version: 1.2\nproperty_value: terms:license https://x.org/by/4.0\n\n[Term]\nid: X:1\nname: One\ndef: "First \\"one\\"." [ref]\n\n[Term]\nid: X:2\nname: Two\nis_obsolete: true\n\n[Typedef]\nid: p\n')
    terms, head = texts.read_obo(spark, f"file://{tmp_path}/o.obo")
    got = {r.id: r for r in terms.collect()}
    assert got["X:1"].definition == 'First "one".' and got["X:2"].is_obsolete and len(got) == 2 and head.head().licence == "https://x.org/by/4.0"
    (tmp_path / "c.gc").write_text('<L><Row><Value ColumnRef="Code"><SimpleValue>1</SimpleValue></Value><Value ColumnRef="Name"><SimpleValue>One</SimpleValue></Value></Row></L>')
    assert tuple(xml.read_genericode(spark, f"file://{tmp_path}/c.gc").head())[1:] == ("1", "One")


def test_sequences(spark, tmp_path):
    (tmp_path / "p.fasta").write_text(">sp|P1|A_HUMAN Some protein OS=Homo sapiens OX=9606 GN=AB PE=1 SV=2\nMKV\nLL\n>sp|P2|B_X Other\nAA\n")
    got = {r.accession: r for r in texts.read_fasta(spark, f"file://{tmp_path}/p.fasta").collect()}
    assert got["P1"].sequence == "MKVLL" and got["P1"].organism == "Homo sapiens" and got["P1"].gene == "AB" and got["P1"].description == "Some protein" and got["P2"].gene == "Unknown gene"
    (tmp_path / "bad.fasta").write_text(">nothing here\nAA\n")
    with pytest.raises(Exception, match="malformed header"):
        texts.read_fasta(spark, f"file://{tmp_path}/bad.fasta").collect()


def test_delimited(spark, tmp_path):
    (tmp_path / "v.tsv").write_text('VariationID\tName\tClinicalSignificance\tPhenotypeList\tRCVaccession\tAssembly\n1\tn"1\t-\tp\tR\tGRCh38\n')
    assert tuple(tables.read_variants(spark, f"file://{tmp_path}/v.tsv").head())[:4] == (1, 'n"1', None, "p")
    (tmp_path / "s.tsv").write_text("1\tC\n3\tCC\n")
    (tmp_path / "i.tsv").write_text("1\tmethane\n2\tx\n")
    read = lambda n, c: tables.read_compound_property(spark, f"file://{tmp_path}/{n}", c)
    merged = articles.merge_compounds(read("s.tsv", "smiles"), read("i.tsv", "iupac_name"), read("i.tsv", "title"), read("i.tsv", "formula"))
    assert [(r.cid, r.iupac_name) for r in merged.orderBy("cid").collect()] == [(1, "methane"), (3, None)]
    (tmp_path / "r.txt").write_text('nct_id|name|start\nN1|"a\nb"|2020-01-02\nN2||x\n')
    got = tables.read_registry(spark, f"file://{tmp_path}/r.txt", {"start": "date"}).orderBy("nct_id").collect()
    assert got[0].name == "a\nb" and str(got[0].start_as_date) == "2020-01-02" and got[1].name is None and got[1].start_as_date is None
    (tmp_path / "m.csv").write_text("PMID,PMCID,DOI\n1,PMC1,\n1,PMC1,\n,,10.1/x\n")
    assert tables.read_id_mappings(spark, f"file://{tmp_path}/m.csv").count() == 2
    (tmp_path / "l.txt").write_text("alb|sqi|sq|Albanian|albanais\nger|deu|de|German|allemand\n")
    assert {r.code for r in tables.read_language_codes(spark, f"file://{tmp_path}/l.txt").collect()} == {"sqi", "deu"}
    assert tables.compare_columns({"a": ["x"]}, {"a": ["x", "y"]}) == {"a": {"only_in_file": [], "only_in_dictionary": ["y"]}}


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.json", json.dumps({"results": [{"id": "1"}, {"id": "2"}]}))
        z.writestr("x.txt", "no")
    (tmp_path / "c.zip").write_bytes(b"PK broken")
    members = archives.read_members(spark, f"file://{tmp_path}/a.zip", ".json")
    assert sorted(r.item.id for r in archives.json_items(members, "id:string").collect()) == ["1", "2"]
    assert archives.read_members(spark, f"file://{tmp_path}/c.zip").head().error.startswith("BadZipFile")
    assert archives.unique_names(["a", "b", "a"]) == ["a", "b", "a_2"]


def test_full_text(spark, tmp_path):
    f = xml.jats_fields('<article xml:lang="en"><front><article-meta><article-id pub-id-type="pmid">5</article-id><title-group><article-title>T <i>x</i></article-title></title-group><contrib-group><contrib><name><surname>Doe</surname><given-names>J</given-names></name></contrib></contrib-group>'
                        "<pub-date><year>2001</year></pub-date><abstract><p>Longer one</p></abstract><abstract><p>Short</p></abstract></article-meta></front><body><p>B</p></body></article>")  # fmt: skip
    assert (f["title"], f["abstract"], f["authors"], f["year"], f["pmid"], f["language"], f["body_text"]) == ("T x", "Short", ["J Doe"], 2001, "5", "en", "B")
    (tmp_path / "bad.xml").write_text("<article>")
    assert xml.parse_jats(spark.read.format("binaryFile").load(f"file://{tmp_path}/bad.xml")).head().error.startswith("ParseError")


def test_json_and_rules(spark, tmp_path):
    (tmp_path / "w.jsonl").write_text('{"id": "https://openalex.org/W1", "title": "t"}\nnot json\n')
    good, bad = texts.read_json_records(spark, f"file://{tmp_path}/w.jsonl", "id string, title string")
    assert good.count() == 1 and bad.head().bad_lines == 1
    (tmp_path / "x_fr.jsonl").write_text(json.dumps({"content": "c" * 60}) + "\n" + json.dumps({"id": "k", "text": "short", "lang": "EN"}) + "\n{}\n")
    rows, drops = texts.read_multilingual(spark, f"file://{tmp_path}/x_fr.jsonl")
    assert rows.head().language == "fr" and len(rows.head().id) == 40 and {r.reason: r["count"] for r in drops.collect()} == {"too_short": 1, "no_text": 1}
    (tmp_path / "qa.jsonl").write_text('{"Question": "q"}\n')
    assert texts.read_guidelines(spark, f"file://{tmp_path}/qa.jsonl") is None
    (tmp_path / "g.jsonl").write_text('{"id": "1", "title": "None", "clean_text": "x"}\n')
    assert tuple(texts.read_guidelines(spark, f"file://{tmp_path}/g.jsonl").head())[2:4] == (None, "x")
    assert files.read_shards(spark, [], [f"file://{tmp_path}/g.jsonl"]).head().filename == "g.jsonl"


def test_feeds(spark, tmp_path):
    lines = [{"n": "1", "names": ["Drug A|drug b", "DRUG  A"], "p": ["12-34"], "d": "3/4/2020"}] * 2 + [{"names": ["x"], "d": None}]
    (tmp_path / "f.jsonl").write_text("\n".join(map(json.dumps, lines)))
    feed = feeds.Feed("ds", "json_lines", "EU", key_fields=("n",), name_fields=("names",), product_fields=("p",), date_field="d")
    rows, counters = feeds.prepare(feeds.read_feed(spark, feed, f"file://{tmp_path}/f.jsonl"), feed, "r1")
    got = {r.record_key[:2]: r for r in rows.collect()}
    assert got["1"].substance_names == ["drug a", "drug b"] and got["1"].product_keys == ["000120034"] and str(got["1"].event_date) == "2020-04-03" and "h:" in got
    c = counters.head()
    assert (c["rows"], c.exact_duplicates, c["keys"], c.undated) == (3, 1, 2, 1)
    feeds.check_counts(counters, 2)
    with pytest.raises(ValueError):
        feeds.check_counts(counters, 3)
    with pytest.raises(ValueError):
        feeds.read_feed(spark, feeds.Feed("x", "fax", "EU"), "p")


def test_incremental_ingest(spark, tmp_path):
    from galenus.streaming.ingest import ingest_new_files

    (tmp_path / "in").mkdir()
    run = lambda: ingest_new_files(spark, f"file://{tmp_path}/in", "id string, title string", f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "s").awaitTermination()
    (tmp_path / "in" / "a.json").write_text('{"id": "1", "title": "x"}')
    run()
    (tmp_path / "in" / "b.json").write_text('{"id": "2", "title": "y"}')
    run()
    run()
    assert {(r.id, r.source_file) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()} == {("1", "a.json"), ("2", "b.json")}


def tar_of(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, text in members:
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def test_books(spark, tmp_path):
    meta = "<book-meta><book-title-group><book-title>The Book</book-title></book-title-group><pub-date><year>2011</year></pub-date><publisher><publisher-name>P</publisher-name></publisher><isbn>1</isbn><contrib-group><contrib contrib-type='editor'><name><surname>Doe</surname></name></contrib></contrib-group><abstract><p>About it.</p></abstract><permissions><license><p>CC BY 4.0</p></license></permissions></book-meta>"
    part = lambda i, title, body: f"<book-part id='{i}'><book-part-meta><title-group><title>{title}</title></title-group></book-part-meta><body>{body}</body></book-part>"
    nested = part("c2", "Two", "<p>two</p>" + part("c3", "Three", "<p>three</p>"))
    tar_of(tmp_path / "B1.tar.gz", [
        ("x/other.nxml", f"<book-part-wrapper>{part('c1', 'One', '<p>again</p>')}</book-part-wrapper>"), ("x/B1.nxml", f"<book>{meta}<book-body>{part('c1', 'One', '<p>one</p>')}{part('c0', 'Index', '<p>a 1</p>')}{part('c9', 'Empty', '')}{nested}"
         f"{part('c8', 'Words', '<index><p>short</p></index>')}</book-body></book>"), ("x/fig.xml", "<figure/>"),
    ])
    tar_of(tmp_path / "B2.tar.gz", [("a.xml", "<article/>")])
    got = {r.id or r.source_file: r for r in books.parse_books(spark.read.format("binaryFile").load(f"file://{tmp_path}/*.gz")).collect()}
    whole = got["book:B1"]
    about = json.loads(whole.book_meta)
    assert (whole.title, whole.text, whole.year, whole.license_raw) == ("The Book", "About it.", 2011, "CC BY 4.0") and about["n_parts"] == 4 and about["skipped_members"] == ["x/fig.xml"] and about["editors"] == ["Doe"]
    assert {i: r.text for i, r in got.items() if r.container_id} == {"book:B1:c1": "again", "book:B1:c1__B1": "one", "book:B1:c2": got["book:B1:c2"].text, "book:B1:c3": "three"}
    assert "two" in got["book:B1:c2"].text and "three" in got["book:B1:c2"].text and got["book:B1:c1__B1"].source_record_id == "c1"
    assert next(r for r in got.values() if r.error).error.startswith("ValueError")


def test_bulk_articles(spark, tmp_path):
    article = lambda ids, body: "<article><front><article-meta>" + "".join(f"<article-id pub-id-type='{k}'>{v}</article-id>" for k, v in ids) + f"<title-group><article-title>T</article-title></title-group><permissions><license xmlns:x='http://www.w3.org/1999/xlink' x:href='https://l/'><license-p>free</license-p></license></permissions></article-meta></front>{body}</article>"
    text = "<body><p>Text</p><response><article><body><p>inner</p></body></article></response></body>"
    articles = [article([("archive", "PPR1"), ("doi", "10.1/a")], text), article([("other", "PPR2")], text), article([("pmid", "5")], text), article([("archive", "PPR3")], ""), article([("archive", "PPR1"), ("doi", "10.1/a")], text)]
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress(f"<articles>{''.join(articles)}</articles>".encode()))
    (tmp_path / "b.xml").write_text(f"<articles>{articles[0]}<article>")
    parsed = bulk.parse_bulk(spark.read.format("binaryFile").load(f"file://{tmp_path}/*"))
    kept, skipped = bulk.preprints(parsed)
    rows = {(r.source_file.split("/")[-1], r.id): r for r in kept.collect()}
    assert set(rows) == {("a.xml.gz", "doi:10.1/a"), ("a.xml.gz", "preprint:PPR2"), ("b.xml", "doi:10.1/a")} and rows["b.xml", "doi:10.1/a"].license_raw == "https://l/ free"
    assert {(r.source_file.split("/")[-1], r.reason, r["count"]) for r in skipped.collect()} == {("a.xml.gz", "no_ppr_id", 1), ("a.xml.gz", "no_text", 1), ("a.xml.gz", "duplicate_id", 1), ("b.xml", "damaged", 1)}


def test_manuscripts(spark, tmp_path):
    tar_of(tmp_path / "m.tar.gz", [("PMC1/PMC12.txt", "The body"), ("PMC1/PMC12.xml", "<article><body><p>Text</p></body></article>"), ("notes.txt", "none"), ("x.jpg", "no")])
    got = {r.id.split("/")[-1]: r for r in bulk.manuscripts(spark, f"file://{tmp_path}/m.tar.gz").collect()}
    assert set(got) == {"manuscript:PMC12:txt", "manuscript:PMC12:xml", "m.tar.gz:notes.txt"} and got["manuscript:PMC12:txt"].body_text == "The body" and got["manuscript:PMC12:xml"].body_text == "Text"
    assert got["m.tar.gz:notes.txt"].pmcid is None and got["manuscript:PMC12:txt"].subset == "text_mining"


def test_substances(spark, tmp_path):
    records = [
        {"unii": " A1 ", "names": [{"name": " "}, {"name": "First"}, {"name": "Chosen\u0000 ", "preferred": True}], "codes": [{"code_system": "RXCUI", "code": "7"}, {"code_system": "WHO-ATC", "code": "a01"}, {"code_system": "WHO-VATC", "code": "q"}],
         "relationships": [{"type": "ACTIVE MOIETY", "related_substance": {"unii": "A1"}}, {"type": "ACTIVE MOIETY", "related_substance": {"unii": "M1"}}, {"type": "ACTIVE MOIETY", "related_substance": {"unii": "M2"}}]},
        {"unii": "B", "names": [{"name": "FIRST"}, {"name": "x" * 3000}], "relationships": [{"type": "OTHER", "related_substance": {"unii": "Z"}}]}, {"unii": None, "names": [{"name": "lost"}]}, {"unii": "C"},
    ]
    (tmp_path / "s.json").write_text(json.dumps({"meta": {}, "results": records}))
    read = substances.read_substances(spark, f"file://{tmp_path}/s.json").cache()
    assert {tuple(r) for r in substances.substance_rows(read).collect()} == {("A1", "Chosen", "M1", True), ("B", "FIRST", "B", False), ("C", None, "C", False)}
    pairs, long_names = substances.cross_references(read)
    assert {tuple(r) for r in pairs.collect()} == {("A1", "name", "first"), ("A1", "name", "chosen"), ("A1", "rxcui", "7"), ("A1", "atc", "A01"), ("A1", "unii", "A1"), ("B", "name", "first"), ("B", "unii", "B"), ("C", "unii", "C")}
    assert long_names.count() == 1


def test_highest_versions(spark):
    names = ["a/PMC1.1.json", "a/PMC1.2.json", "b/PMC1.2.json", "a/PMC2000001.1.json", "a/readme.md"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    kept, counts = files.highest_versions(rows, F.regexp_extract("path", r"([^/]+)$", 1))
    assert {r.path for r in kept.collect()} == {"a/PMC1.2.json", "a/PMC2000001.1.json"}
    assert {tuple(r) for r in counts.collect()} == {(0, 1, 1, 1, 0), (2, 1, 0, 0, 0), (None, 0, 0, 0, 1)}


def test_unmarked_shards(spark, tmp_path):
    table = pa.table({"x": [1]})
    pq.write_table(table.replace_schema_metadata({"ids": "2"}), tmp_path / "a.parquet")
    pq.write_table(table, tmp_path / "b.parquet")
    (tmp_path / "c.jsonl").write_text("{}")
    paths = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("a.parquet", "b.parquet", "c.jsonl")], "path string")
    assert {(r.path.split("/")[-1], r.problem) for r in gate.unmarked_shards(paths, "ids", "2").collect()} == {("b.parquet", "no ids=2"), ("c.jsonl", "not parquet")}


def test_code_hash_follows_the_imports():
    a = gate.code_hash("galenus.operators.recall")
    assert a == gate.code_hash("galenus.operators.recall") != gate.code_hash("galenus.functions.lots") and len(a) == 64
    assert gate.unexpected_missing({"a", "b", "c"}, {"a"}, {"c"}) == ["b"]
