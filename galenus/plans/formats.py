"""Source queries: a provided table is written in a source's format to the shared folder and read back by its reader.

Files that no writer of Spark makes (archives, one JSON or XML document) hold the nation table, 25 rows at any scale.
"""

from __future__ import annotations

import gzip
import io
import json
import tarfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions import sentences
from galenus.operators import load
from galenus.operators.checkpoints import put, scratch
from galenus.plans.registry import query
from galenus.session import table
from galenus.sources import archives, books, bulk, files, substances, tables, texts, xml


def _lines(df: DataFrame, value: Column, name: str, separator: str = "\n") -> str:
    path = scratch(df.sparkSession, name)
    df.select(value.alias("value")).write.option("lineSep", separator).text(path)
    return path


def _csv(df: DataFrame, name: str, sep: str, header: bool = True) -> str:
    path = scratch(df.sparkSession, name)
    df.write.option("sep", sep).option("header", header).option("emptyValue", "").option("escape", '"').option("quote", '"').csv(path)
    return path


def _xml(df: DataFrame, tag: str) -> str:
    path = scratch(df.sparkSession, tag)
    df.write.format("xml").option("rootTag", f"{tag}Set").option("rowTag", tag).save(path)
    return path


def _nations(spark: SparkSession, d: str) -> list:
    return table(spark, d, "nation").orderBy("n_nationkey").collect()


def _tar(members: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))
    return out.getvalue()


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


@query("""
select c_custkey as variation_id, nullif(case when c_custkey % 3 = 0 then '-' else c_name end, '-') as name, nullif(case when c_custkey % 4 = 0 then '-' else c_mktsegment end, '-') as clinical_significance,
       'Variant '  || c_name || case when c_custkey % 4 = 0 then '' else ' is classified ' || c_mktsegment end || ', as catalogued in the NCBI ClinVar database.' as sentence
from customer where c_custkey % 3 <> 0 union all
select c_custkey, null, nullif(case when c_custkey % 4 = 0 then '-' else c_mktsegment end, '-'),
       'ClinVar variation ' || c_custkey || case when c_custkey % 4 = 0 then '' else ' is classified ' || c_mktsegment end || ', as catalogued in the NCBI ClinVar database.' from customer where c_custkey % 3 = 0
""")
def variant_file(spark: SparkSession, d: str) -> DataFrame:
    c, k = F.col, F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.alias("VariationID"), F.when(k % 3 == 0, "-").otherwise(c("c_name")).alias("Name"), F.when(k % 4 == 0, "-").otherwise(c("c_mktsegment")).alias("ClinicalSignificance"), F.lit("-").alias("PhenotypeList"), F.lit("-").alias("RCVaccession"), F.lit("GRCh38").alias("Assembly"))
    v = tables.read_variants(spark, _csv(rows, "variants", "\t"))
    return v.select("variation_id", "name", "clinical_significance", sentences.variant(c("variation_id"), c("name"), c("clinical_significance"), c("phenotype_list"), c("rcv_accession")).alias("sentence"))


@query("select p_partkey as cid, p_name as title from part where p_partkey % 5 <> 0")
def compound_file(spark: SparkSession, d: str) -> DataFrame:
    """A property file; rows without a cid are left out."""
    key = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_partkey").cast("string"))
    return tables.read_compound_property(spark, _lines(table(spark, d, "part"), F.concat(key, F.lit("\t"), F.col("p_name")), "compounds"), "title")


@query("""
select 'R-' || n_nationkey as pathway_id, 'Reactome pathway ' || n_name || ' (Homo sapiens)' || case when n_nationkey % 2 = 0 then '. About ' || n_name else '.' end || ' As catalogued in the Reactome pathway database.' as sentence from nation
""")
def pathway_files(spark: SparkSession, d: str) -> DataFrame:
    n, c = table(spark, d, "nation"), F.col
    key = F.concat(F.lit("R-"), c("n_nationkey").cast("string"))
    a = _lines(n, F.concat_ws("\t", key, "n_name", F.lit("Homo sapiens")), "pathways")
    b = _csv(n.filter("n_nationkey % 2 = 0").select(key.alias("id"), c("n_name").alias("name"), F.concat(F.lit("About "), "n_name").alias("summation")), "summations", "\t")
    m = _lines(n, F.concat_ws("\t", F.lit("P1"), key, F.lit("u"), c("n_name"), F.lit("IEA"), F.lit("Homo sapiens")), "members")
    paths, sums, members = tables.read_pathways(spark, a, b, m)
    j = paths.join(sums, "pathway_id", "left").join(members.select("pathway_id").distinct(), "pathway_id")
    return j.select("pathway_id", sentences.pathway(c("name"), c("species"), c("summation"), F.lit(None).cast("string"), F.lit(0)).alias("sentence"))


@query("select 'C' || n_nationkey as code, 'L' || n_regionkey as codelist_code, n_name as submission_value from nation")
def codelist_file(spark: SparkSession, d: str) -> DataFrame:
    rows = ["\t".join(tables.CODELIST_HEADER)] + ["\t".join((f"C{r.n_nationkey}", f"L{r.n_regionkey}", "", "List", r.n_name, "", "", "")) for r in _nations(spark, d)]
    path = put(spark, scratch(spark, "codelist") + ".txt", "\n".join(rows).encode())
    return tables.read_codelists(spark, path).select("code", "codelist_code", "submission_value")


@query("select cast(o_orderkey as varchar) as nct_id, nullif(case when o_orderkey % 7 = 0 then '' else o_orderstatus || ' \"x|y\"' end, '') as status, strftime(o_orderdate, '%Y-%m-%d') as started, cast(o_orderdate as date) as started_as_date from orders")
def registry_file(spark: SparkSession, d: str) -> DataFrame:
    """A pipe-delimited export with quoted separators; a dictionary makes typed copies."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.alias("nct_id"), F.when(k % 7 == 0, "").otherwise(F.concat("o_orderstatus", F.lit(' "x|y"'))).alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("started"))
    return tables.read_registry(spark, _csv(rows, "registry", "|"), {"started": "date"})


@query("select distinct nullif(cast(o_custkey as varchar), '1') as pmid, 'PMC' || o_custkey as pmcid, nullif(case when o_custkey % 2 = 0 then '10.1/' || o_custkey else '' end, '') as doi from orders")
def id_mapping_file(spark: SparkSession, d: str) -> DataFrame:
    """Distinct id triples; the header line is no row."""
    k = F.col("o_custkey").cast("string")
    rows = table(spark, d, "orders").select(F.nullif(k, F.lit("1")).alias("PMID"), F.concat(F.lit("PMC"), k).alias("PMCID"), F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("10.1/"), k)).alias("DOI"))
    return tables.read_id_mappings(spark, _csv(rows, "mappings", ","))


@query("""
select 'S' || s_suppkey as accession, 'N' || s_suppkey || '_X' as entry_name, s_name as description, case when s_suppkey % 2 = 0 then 'Homo sapiens' else 'Unknown organism' end as organism, 'G' || s_nationkey as gene, 'MKV' || repeat('A', s_suppkey % 9 + 1) as sequence,
       'Protein N' || s_suppkey || '_X (' || s_name || ') in organism ' || case when s_suppkey % 2 = 0 then 'Homo sapiens' else 'Unknown organism' end || ' is encoded by gene G' || s_nationkey || '. Its amino acid sequence is: MKV' || repeat('A', s_suppkey % 9 + 1) as sentence
from supplier
""")
def sequence_file(spark: SparkSession, d: str) -> DataFrame:
    c, k = F.col, F.col("s_suppkey").cast("string")
    organism = F.when(c("s_suppkey") % 2 == 0, " OS=Homo sapiens OX=9606").otherwise("")
    value = F.concat(F.lit(">sp|S"), k, F.lit("|N"), k, F.lit("_X "), "s_name", organism, F.lit(" GN=G"), c("s_nationkey").cast("string"), F.lit(" PE=1 SV=1\nMKV\n"), F.repeat(F.lit("A"), (c("s_suppkey") % 9 + 1).cast("int")))
    p = texts.read_fasta(spark, _lines(table(spark, d, "supplier"), value, "sequences")).drop("source_file")
    return p.withColumn("sentence", sentences.protein(c("entry_name"), c("description"), c("organism"), c("gene"), c("sequence")))


@query("""
select 'X:' || p_partkey as id, p_name as name, case when p_size % 2 = 0 then 'a "' || p_brand || '" part' end as definition, p_size % 10 = 0 as is_obsolete, p_name || case when p_size % 2 = 0 then ': a "' || p_brand || '" part' else '' end as sentence from part
""")
def ontology_file(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    definition = F.when(c("p_size") % 2 == 0, F.concat(F.lit('\ndef: "a \\"'), "p_brand", F.lit('\\" part" [x]'))).otherwise("")
    value = F.concat(F.lit("[Term]\nid: X:"), c("p_partkey").cast("string"), F.lit("\nname: "), "p_name", definition, F.when(c("p_size") % 10 == 0, "\nis_obsolete: true").otherwise(""))
    terms, _ = texts.read_obo(spark, _lines(table(spark, d, "part"), value, "ontology", "\n\n"))
    return terms.select("id", "name", "definition", "is_obsolete", sentences.term(c("name"), c("definition")).alias("sentence"))


@query("select count(*) filter (event_id % 50 <> 0) as records, count(*) filter (event_id % 50 = 0) as bad_lines from events")
def json_lines_file(spark: SparkSession, d: str) -> DataFrame:
    """Records with a declared schema; a torn line is counted, not raised."""
    whole = F.to_json(F.struct("event_id", "event_type"))
    value = F.when(F.col("event_id") % 50 == 0, F.substring(whole, 1, 12)).otherwise(whole)
    good, bad = texts.read_json_records(spark, _lines(table(spark, d, "events"), value, "works"), "event_id long, event_type string")
    return good.agg(F.count("event_id").alias("records")).crossJoin(bad)


@query("""
with r as (select coalesce(nullif(trim(text), ''), '') as t from documents)
select case when t = '' then 'no_text' when length(t) < 200 then 'too_short' else 'kept' end as outcome, count(*) as n from (select regexp_replace(t, '^ +| +$', '', 'g') as t from r) group by 1
""")
def multilingual_file(spark: SparkSession, d: str) -> DataFrame:
    """Documents as JSON lines under different body keys: kept and dropped rows."""
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    rows = docs.select(k.cast("string").alias("id"), "lang", F.when(k % 2 == 0, F.col("text")).alias("content"), F.when(k % 2 == 1, F.col("text")).alias("passage"))
    path = scratch(spark, "multilingual")
    rows.write.json(path)
    kept, dropped = texts.read_multilingual(spark, path, 200)
    return kept.agg(F.lit("kept").alias("outcome"), F.count("*").alias("n")).unionByName(dropped.select(F.col("reason").alias("outcome"), F.col("count").alias("n")))


@query("select cast(doc_id as varchar) as id, source as publisher, nullif(case when doc_id % 3 = 0 then 'None' else lang end, 'None') as title, sha256(text) as body from documents")
def guideline_file(spark: SparkSession, d: str) -> DataFrame:
    """Columns found by candidate names; a literal None is null."""
    path = scratch(spark, "guidelines") + ".parquet"
    table(spark, d, "documents").select(F.col("doc_id").alias("ID"), F.col("source").alias("publisher"), F.when(F.col("doc_id") % 3 == 0, "None").otherwise(F.col("lang")).alias("Title"), F.col("text").alias("clean_text")).write.parquet(path)
    return texts.read_guidelines(spark, path).select("id", "publisher", "title", F.sha2("body_text", 256).alias("body"))


@query("""
select 'D' || n_nationkey as descriptor_ui, 'A' || n_regionkey || '.' || n_nationkey as tree_number, n_name || '.' || case when n_nationkey % 2 = 0 then ' About ' || n_name else '' end || ' As defined in the NLM Medical Subject Headings (MeSH) thesaurus.' as sentence from nation
""")
def descriptor_file(spark: SparkSession, d: str) -> DataFrame:
    c, k = F.col, F.col("n_nationkey").cast("string")
    note = F.when(c("n_nationkey") % 2 == 0, F.concat(F.lit("About "), "n_name"))
    concept = lambda preferred, text: F.struct(F.lit(preferred).alias("_PreferredConceptYN"), text.alias("ScopeNote"))
    record = table(spark, d, "nation").select(
        F.concat(F.lit("D"), k).alias("DescriptorUI"), F.struct(c("n_name").alias("String")).alias("DescriptorName"), F.struct(F.array(F.concat(F.lit("A"), c("n_regionkey").cast("string"), F.lit("."), k)).alias("TreeNumber")).alias("TreeNumberList"),
        F.struct(F.array(concept("N", F.lit("no")), concept("Y", note)).alias("Concept")).alias("ConceptList"),
    )
    heads, trees = xml.read_descriptors(spark, _xml(record, "DescriptorRecord"))
    return heads.join(trees, "descriptor_ui").select("descriptor_ui", "tree_number", sentences.descriptor(c("name"), c("scope_note")).alias("sentence"))


@query("""
select o_orderkey::varchar as pmid, 'Title ' || o_orderkey as title, case when o_orderkey % 3 = 0 then null else 1990 + o_orderkey % 30 end::int as year, case when o_orderkey % 2 = 0 then 'AIM: To test ' || o_orderkey || '.' end as abstract, 'D' || o_custkey as mesh, (o_custkey * 7)::varchar as cited from orders
""")
def literature_file(spark: SparkSession, d: str) -> DataFrame:
    """Orders as literature records: article rows with their descriptor and citation edges."""
    k, c = F.col("o_orderkey").cast("string"), F.col
    pack = lambda **parts: F.struct(*(v.alias(n) for n, v in parts.items()))
    year = F.when(c("o_orderkey") % 3 != 0, (1990 + c("o_orderkey") % 30).cast("string"))
    abstract = F.when(c("o_orderkey") % 2 == 0, pack(AbstractText=F.array(pack(_Label=F.lit("AIM"), _VALUE=F.concat(F.lit("To test "), k, F.lit("."))))))
    article = pack(ArticleTitle=F.concat(F.lit("Title "), k), Abstract=abstract, Language=F.array(F.lit("eng")), Journal=pack(Title=F.lit("J"), JournalIssue=pack(PubDate=pack(Year=year))))
    heading = pack(DescriptorName=pack(_UI=F.concat(F.lit("D"), c("o_custkey").cast("string")), _MajorTopicYN=F.lit("N"), _VALUE=F.lit("x")))
    ids = lambda value: pack(ArticleId=F.array(pack(_IdType=F.lit("pubmed"), _VALUE=value)))
    reference = pack(Citation=F.lit("Ref"), ArticleIdList=ids((c("o_custkey") * 7).cast("string")))
    citation = pack(PMID=pack(_Version=F.lit("1"), _VALUE=k), Article=article, MeshHeadingList=pack(MeshHeading=F.array(heading)))
    rows = table(spark, d, "orders").select(citation.alias("MedlineCitation"), pack(ArticleIdList=ids(k), ReferenceList=F.array(pack(Reference=F.array(reference)))).alias("PubmedData"))
    records = xml.read_literature(spark, _xml(rows, "PubmedArticle"))
    edges = xml.literature_edges(records)
    rows = xml.literature_articles(records).select("pmid", "title", "year", "abstract")
    rows = rows.join(edges["mesh"].select("pmid", F.col("descriptor_ui").alias("mesh")), "pmid", "left")
    return rows.join(edges["cites"].select(F.col("src_pmid").alias("pmid"), F.col("dst_pmid").alias("cited")), "pmid", "left")


@query("""
select case when n_nationkey % 3 = 0 then 'doi:10.1/' || n_nationkey else 'preprint:PPR' || n_nationkey end as id, n_name as title from nation where n_nationkey % 5 not in (1, 2)
union all select 'skipped ' || r, n::varchar from (select 'no_ppr_id' as r, count(*) as n from nation where n_nationkey % 5 = 1 union all select 'no_text', count(*) from nation where n_nationkey % 5 = 2 union all select 'duplicate_id', count(*) from nation where n_nationkey % 5 = 0)
""")
def bulk_article_file(spark: SparkSession, d: str) -> DataFrame:
    """A bulk file of articles: usable rows, and the others by reason."""

    def article(r) -> str:
        k = r.n_nationkey
        ids = ("" if k % 5 == 1 else f'<article-id pub-id-type="archive">PPR{k}</article-id>') + (f'<article-id pub-id-type="doi">10.1/{k}</article-id>' if k % 3 == 0 else "")
        body = "" if k % 5 == 2 else "<body><p>Text</p></body>"
        return f"<article><front><article-meta>{ids}<title-group><article-title>{r.n_name}</article-title></title-group></article-meta></front>{body}</article>" * (2 if k % 5 == 0 else 1)

    data = gzip.compress(f"<articles>{''.join(map(article, _nations(spark, d)))}</articles>".encode())
    kept, skipped = bulk.preprints(bulk.parse_bulk(_binary(spark, put(spark, scratch(spark, "bulk") + ".xml.gz", data))))
    reasons = skipped.groupBy("reason").agg(F.sum("count").alias("n"))
    return kept.select("id", "title").unionByName(reasons.select(F.concat(F.lit("skipped "), "reason").alias("id"), F.col("n").cast("string").alias("title")))


@query("""
select 'book:B' || r_regionkey as id, null as container_id, r_name as title, (select count(*) from nation where n_regionkey = r_regionkey and n_nationkey % 4 <> 0)::varchar as detail from region
union all select 'book:B' || n_regionkey || ':p' || n_nationkey, 'book:B' || n_regionkey, n_name, 'about ' || n_name from nation where n_nationkey % 4 <> 0
""")
def book_packages(spark: SparkSession, d: str) -> DataFrame:
    """A region is a book, its nations are parts; some have no body."""
    parts: dict[int, str] = {}
    for r in _nations(spark, d):
        body = "" if r.n_nationkey % 4 == 0 else f"<body><p>about {r.n_name}</p></body>"
        parts[r.n_regionkey] = parts.get(r.n_regionkey, "") + f"<book-part id='p{r.n_nationkey}'><book-part-meta><title-group><title>{r.n_name}</title></title-group></book-part-meta>{body}</book-part>"
    folder = scratch(spark, "books")
    for r in table(spark, d, "region").collect():
        meta = f"<book-meta><book-title-group><book-title>{r.r_name}</book-title></book-title-group></book-meta>"
        put(spark, f"{folder}/B{r.r_regionkey}.tar.gz", _tar({f"B{r.r_regionkey}.nxml": f"<book>{meta}<book-body>{parts.get(r.r_regionkey, '')}</book-body></book>"}))
    rows = books.parse_books(_binary(spark, folder))
    return rows.select("id", "container_id", "title", F.coalesce("text", F.get_json_object("book_meta", "$.n_parts")).alias("detail"))


@query("select 'manuscript:PMC' || n_nationkey || ':txt' as id, 'PMC' || n_nationkey as pmcid, 'The text of ' || n_name as body_text from nation")
def manuscript_archive(spark: SparkSession, d: str) -> DataFrame:
    data = _tar({f"a/PMC{r.n_nationkey}.txt": f"The text of {r.n_name}" for r in _nations(spark, d)})
    return bulk.manuscripts(spark, put(spark, scratch(spark, "manuscripts") + ".tar.gz", data)).select("id", "pmcid", "body_text")


@query("""
select 'U' || n_nationkey as unii, case when n_nationkey % 3 = 0 then 'Chosen ' || n_name else n_name end as name, case when n_nationkey % 2 = 0 then 'M' || n_regionkey else 'U' || n_nationkey end as moiety_unii, 3 + (n_nationkey % 3 = 0)::int as n_pairs from nation where n_nationkey <> 7
""")
def substance_file(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document of substance records, streamed: name, moiety and number of cross references."""

    def record(r) -> dict:
        k = r.n_nationkey
        names = [{"name": " "}, {"name": r.n_name}] + [{"name": f"Chosen {r.n_name}", "preferred": True}] * (k % 3 == 0)
        codes = [{"code_system": "WHO-ATC", "code": f"a{k}"}, {"code_system": "WHO-VATC", "code": "q"}]
        moieties = [{"type": "ACTIVE MOIETY", "related_substance": {"unii": u}} for u in (f"U{k}", f"M{r.n_regionkey}")][: 2 if k % 2 == 0 else 1]
        return {"unii": f" U{k}" if k != 7 else None, "names": names, "codes": codes, "relationships": moieties}

    path = put(spark, scratch(spark, "substances") + ".json", json.dumps({"meta": {}, "results": [record(r) for r in _nations(spark, d)]}).encode())
    records = substances.read_substances(spark, path)
    pairs, _ = substances.cross_references(records)
    return substances.substance_rows(records).drop("several").join(pairs.groupBy("unii").agg(F.count("*").cast("int").alias("n_pairs")), "unii")


@query("select n_nationkey as k, n_name as v from nation")
def zipped_json_feed(spark: SparkSession, d: str) -> DataFrame:
    """Items of a JSON document in a zip file."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("part.json", json.dumps({"results": [{"k": r.n_nationkey, "v": r.n_name} for r in _nations(spark, d)]}))
    path = put(spark, scratch(spark, "feed") + ".zip", out.getvalue())
    return archives.json_items(archives.read_members(spark, path, ".json"), "k int, v string").select("item.*")


@query("select 'loinc' as system_key, n_nationkey || '-' || n_regionkey as code, n_name || ',\n\"x\"' as label from nation")
def zipped_code_file(spark: SparkSession, d: str) -> DataFrame:
    """A CSV member with quoted separators, quotes and line breaks."""
    out, q = io.BytesIO(), '"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/codes.csv", '"NUM","NAME"\n' + "".join(f'"{r.n_nationkey}-{r.n_regionkey}","{r.n_name},\n{q * 2}x{q * 2}"\n' for r in _nations(spark, d)))
    return archives.read_code_zip(spark, put(spark, scratch(spark, "codes") + ".zip", out.getvalue()), "codes.csv", "loinc", "NUM", "NAME")


@query("""
select 'dailymed:s' || n_nationkey as article_id, '34067-9' as loinc_code, upper(n_name) as title, 0 as start_offset, (length(n_name) + 1 + length('About ' || n_name))::int as end_offset, case when n_nationkey % 2 = 0 then 'U' || n_regionkey end as unii from nation
""")
def label_files(spark: SparkSession, d: str) -> DataFrame:
    """Labels: coded sections with their offsets, and active substances."""
    folder = scratch(spark, "labels")
    for r in _nations(spark, d):
        drug = f'<component><section><subject><manufacturedProduct><ingredient classCode="ACTIM"><ingredientSubstance><code code="U{r.n_regionkey}" codeSystem="2.16.840.1.113883.4.9"/></ingredientSubstance></ingredient></manufacturedProduct></subject></section></component>' if r.n_nationkey % 2 == 0 else ""
        body = f'<component><section><code code="34067-9" codeSystem="2.16.840.1.113883.6.1"/><title>{r.n_name.upper()}</title><text><paragraph>About  {r.n_name}</paragraph></text></section></component>'
        put(spark, f"{folder}/{r.n_nationkey}.xml", f'<document xmlns="urn:hl7-org:v3"><setId root="s{r.n_nationkey}"/><versionNumber value="1"/><component><structuredBody>{body}{drug}</structuredBody></component></document>'.encode())
    sections, actives = xml.label_sidecar(xml.newest_labels(xml.parse_labels(_binary(spark, folder))))
    return sections.join(actives.select("article_id", "unii"), "article_id", "left").select("article_id", "loinc_code", "title", "start_offset", "end_offset", "unii")


@query("select 'iso639-2' as system_key, case when n_nationkey % 2 = 0 then 't' else 'b' end || n_nationkey as code, n_name as label from nation union all select 'iso3166-1', upper(left(n_name, 2)) || n_nationkey, n_name from nation")
def code_files(spark: SparkSession, d: str) -> DataFrame:
    n, k = table(spark, d, "nation"), F.col("n_nationkey").cast("string")
    languages = _lines(n, F.concat_ws("|", F.concat(F.lit("b"), k), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("t"), k)).otherwise(""), F.lit(""), "n_name", F.lit("x")), "languages")
    countries = _csv(n.select(F.col("n_name").alias("name"), F.concat(F.lower(F.left("n_name", F.lit(2))), k).alias("alpha-2")), "countries", ",")
    return tables.read_language_codes(spark, languages).unionByName(tables.read_country_codes(spark, countries))


@query("select c_custkey as k, case when c_custkey % 2 = 0 then c_name end as name, case when c_custkey % 2 = 1 then c_mktsegment end as segment from customer")
def shard_union(spark: SparkSession, d: str) -> DataFrame:
    """Parquet and JSON-lines shards with different columns, united by name."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    a, b = scratch(spark, "shards-a"), scratch(spark, "shards-b")
    c.filter(k % 2 == 0).select(k.cast("long").alias("k"), F.col("c_name").alias("name")).write.parquet(a)
    c.filter(k % 2 == 1).select(k.cast("long").alias("k"), F.col("c_mktsegment").alias("segment")).write.json(b)
    return files.read_shards(spark, [a], [b]).select("k", "name", "segment")


@query("select source, 2000 + doc_id % 4 as year, count(*) as n, max(text) = max(text) as whole from documents group by all")
def corpus_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The corpus sink read back by partition."""
    path = scratch(spark, "corpus")
    rows = table(spark, d, "documents").select("text", "source", (2000 + F.col("doc_id") % 4).cast("int").alias("year"), F.sha2("text", 256).alias("content_hash"))
    load.write_corpus(rows, path)
    back = spark.read.schema("text string, source string, year long, content_hash string").parquet(path)
    return back.groupBy("source", "year").agg(F.count("*").alias("n"), F.bool_and(F.sha2("text", 256).eqNullSafe(F.col("content_hash"))).alias("whole"))
