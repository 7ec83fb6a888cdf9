"""XML sources: literature records, full-text articles, vocabularies and labels."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions.ids import normalize_orcid
from galenus.functions.markup import local, parse_label, safe_xml

ABSTRACT_CHARS, BODY_CHARS = 50_000, 500_000

_TEXTISH = "struct<_VALUE:string,_Label:string>"
RECORD_SCHEMA = f"""MedlineCitation struct<
  PMID:struct<_VALUE:string>,
  Article:struct<
    ArticleTitle:string, Abstract:struct<AbstractText:array<{_TEXTISH}>>, Language:array<string>,
    Journal:struct<Title:string,ISOAbbreviation:string,JournalIssue:struct<PubDate:struct<Year:string,MedlineDate:string>>>,
    AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,Initials:string,CollectiveName:string,
      Identifier:array<struct<_VALUE:string,_Source:string>>,AffiliationInfo:array<struct<Affiliation:string>>>>>,
    PublicationTypeList:struct<PublicationType:array<struct<_VALUE:string>>>>,
  MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:struct<_VALUE:string,_UI:string,_MajorTopicYN:string>,
    QualifierName:array<struct<_VALUE:string,_UI:string,_MajorTopicYN:string>>>>>,
  ChemicalList:struct<Chemical:array<struct<RegistryNumber:string,NameOfSubstance:struct<_VALUE:string,_UI:string>>>>,
  KeywordList:array<struct<_Owner:string,Keyword:array<struct<_VALUE:string,_MajorTopicYN:string>>>>,
  CommentsCorrectionsList:struct<CommentsCorrections:array<struct<_RefType:string,PMID:struct<_VALUE:string>,RefSource:string>>>>,
PubmedData struct<
  ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>,
  ReferenceList:array<struct<Reference:array<struct<Citation:string,ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>>>>>>"""


def read_literature(spark: SparkSession, path: str) -> DataFrame:
    """Record structs of literature XML, plain or gzip; parallel per file, since gzip can't be split."""
    return spark.read.format("xml").option("rowTag", "PubmedArticle").schema(RECORD_SCHEMA).load(path).withColumn("source_file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def _own_id(kind: str):
    """Of the record's own list, not of its references."""
    found = F.filter("PubmedData.ArticleIdList.ArticleId", lambda a: a["_IdType"] == kind)
    return F.get(F.transform(found, lambda a: F.trim(a["_VALUE"])), F.lit(0))


def literature_articles(records: DataFrame) -> DataFrame:
    """Article rows: labelled abstract parts on lines, authors as written, year from the issue or its free-text date."""
    m, a = "MedlineCitation", "MedlineCitation.Article"
    part = lambda p: F.concat_ws(": ", p["_Label"], F.nullif(F.trim(p["_VALUE"]), F.lit("")))
    abstract = F.array_join(F.filter(F.transform(f"{a}.Abstract.AbstractText", part), lambda t: t != ""), "\n")
    name = lambda x: F.coalesce(x["CollectiveName"], F.nullif(F.concat_ws(" ", F.coalesce(x["ForeName"], x["Initials"]), x["LastName"]), F.lit("")))
    issue = f"{a}.Journal.JournalIssue.PubDate"
    year = F.coalesce(F.col(f"{issue}.Year"), F.nullif(F.regexp_extract(f"{issue}.MedlineDate", r"\d{4}", 0), F.lit(""))).try_cast("int")
    pmid = F.trim(f"{m}.PMID._VALUE")
    return records.select(
        F.concat(F.lit("pubmed:"), pmid).alias("id"), F.lit("pubmed").alias("source"), "source_file", pmid.alias("source_record_id"), pmid.alias("pmid"), _own_id("pmc").alias("pmcid"),
        _own_id("doi").alias("doi"), F.trim(f"{a}.ArticleTitle").alias("title"), F.nullif(abstract, F.lit("")).alias("abstract"),
        F.array_compact(F.transform(f"{a}.AuthorList.Author", name)).alias("authors"), F.coalesce(F.trim(f"{a}.Journal.Title"), F.trim(f"{a}.Journal.ISOAbbreviation")).alias("journal"),
        year.alias("year"), F.array_distinct(F.transform(f"{m}.MeshHeadingList.MeshHeading", lambda h: h["DescriptorName"]["_VALUE"])).alias("mesh"),
        F.transform(f"{a}.PublicationTypeList.PublicationType", lambda p: p["_VALUE"]).alias("publication_types"), F.get(f"{a}.Language", F.lit(0)).alias("language"),
    )


def literature_edges(records: DataFrame) -> dict[str, DataFrame]:
    """Six relations, one explode each; a record without an id has no edges."""
    pmid = F.trim("MedlineCitation.PMID._VALUE").alias("pmid")
    base = records.filter("MedlineCitation.PMID._VALUE is not null")
    m = "MedlineCitation."
    one = lambda path, alias: base.select(pmid, "source_file", F.explode(path).alias(alias))
    ids = lambda kind: F.get(F.transform(F.filter("r.ArticleIdList.ArticleId", lambda i: i["_IdType"] == kind), lambda i: F.trim(i["_VALUE"])), F.lit(0))
    major = lambda h: (h["DescriptorName"]["_MajorTopicYN"] == "Y") | F.exists(F.coalesce(h["QualifierName"], F.array().cast("array<struct<_VALUE:string,_UI:string,_MajorTopicYN:string>>")), lambda q: q["_MajorTopicYN"] == "Y")
    mesh = one(f"{m}MeshHeadingList.MeshHeading", "h").select(
        "pmid", F.col("h.DescriptorName._UI").alias("descriptor_ui"), F.col("h.DescriptorName._VALUE").alias("descriptor_name"), F.coalesce(major(F.col("h")), F.lit(False)).alias("major_topic"),
        F.transform("h.QualifierName", lambda q: q["_UI"]).alias("qualifier_uis"), F.transform("h.QualifierName", lambda q: q["_VALUE"]).alias("qualifiers"), "source_file",
    )
    lists = one("PubmedData.ReferenceList", "l").select("pmid", "source_file", F.explode("l.Reference").alias("r"))
    cites = lists.select(F.col("pmid").alias("src_pmid"), ids("pubmed").alias("dst_pmid"), ids("doi").alias("dst_doi"), F.col("r.Citation").alias("ref_text"), "source_file")
    comments = one(f"{m}CommentsCorrectionsList.CommentsCorrections", "c").select("pmid", F.col("c._RefType").alias("ref_type"), F.col("c.PMID._VALUE").alias("ref_pmid"), F.col("c.RefSource").alias("ref_text"), "source_file")
    chemicals = one(f"{m}ChemicalList.Chemical", "c").select("pmid", F.col("c.NameOfSubstance._UI").alias("substance_ui"), F.col("c.NameOfSubstance._VALUE").alias("name"), F.nullif(F.col("c.RegistryNumber"), F.lit("0")).alias("registry_number"), "source_file")
    words = one(f"{m}KeywordList", "k").select("pmid", "source_file", F.col("k._Owner").alias("owner"), F.explode("k.Keyword").alias("w"))
    keywords = words.select("pmid", F.trim("w._VALUE").alias("keyword"), "owner", (F.coalesce("w._MajorTopicYN", F.lit("N")) == "Y").alias("major_topic"), "source_file")
    people = base.select(pmid, "source_file", F.posexplode(f"{m}Article.AuthorList.Author").alias("at", "a"))
    orcid = F.get(F.filter(F.transform(F.filter("a.Identifier", lambda i: i["_Source"] == "ORCID"), lambda i: normalize_orcid(i["_VALUE"])), lambda o: o.isNotNull()), F.lit(0))
    authors = people.select(
        "pmid", (F.col("at") + 1).alias("position"), F.col("a.LastName").alias("last_name"), F.col("a.ForeName").alias("fore_name"), F.col("a.Initials").alias("initials"),
        F.col("a.CollectiveName").alias("collective_name"), orcid.alias("orcid"), F.transform("a.AffiliationInfo", lambda x: x["Affiliation"]).alias("affiliations"), "source_file",
    )
    return {"mesh": mesh, "cites": cites, "comments": comments, "chemicals": chemicals, "keywords": keywords, "authors": authors}


def read_descriptors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(descriptors: descriptor_ui, name, scope_note of the preferred concept; trees: descriptor_ui, tree_number)."""
    schema = "DescriptorUI string, DescriptorName struct<String:string>, TreeNumberList struct<TreeNumber:array<string>>, ConceptList struct<Concept:array<struct<_PreferredConceptYN:string,ScopeNote:string>>>"
    raw = spark.read.format("xml").option("rowTag", "DescriptorRecord").schema(schema).load(path)
    note = F.get(F.transform(F.filter("ConceptList.Concept", lambda c: c["_PreferredConceptYN"] == "Y"), lambda c: F.trim(c["ScopeNote"])), F.lit(0))
    ui = F.trim("DescriptorUI").alias("descriptor_ui")
    return raw.select(ui, F.trim("DescriptorName.String").alias("name"), note.alias("scope_note")), raw.select(ui, F.explode("TreeNumberList.TreeNumber").alias("tree_number"))


def read_units(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "unit").schema("_Code string, name array<string>").load(path)
    return raw.select(F.lit("ucum").alias("system_key"), F.col("_Code").alias("code"), F.get("name", F.lit(0)).alias("label")).filter("code is not null")


def read_genericode(spark: SparkSession, path: str) -> DataFrame:
    """Rows of genericode lists: code and name columns by their reference."""
    raw = spark.read.format("xml").option("rowTag", "Row").schema("Value array<struct<_ColumnRef:string,SimpleValue:string>>").load(path)
    cell = lambda *names: F.get(F.transform(F.filter("Value", lambda v: F.lower(v["_ColumnRef"]).isin(*names)), lambda v: F.trim(v["SimpleValue"])), F.lit(0))
    return raw.select(F.lit("codelist").alias("system_key"), cell("code", "value").alias("code"), cell("name", "displayname", "label").alias("label"))


def jats_fields(data: bytes | str) -> dict:
    """Title, shortest of the distinct abstracts, first body, authors, journal, year, ids and language of one article."""
    root = safe_xml(data)
    article = root if local(root.tag) == "article" else next((e for e in root.iter() if local(e.tag) == "article"), root)
    every = lambda tag, within=article: [e for e in within.iter() if local(e.tag) == tag]
    flat = lambda e: " ".join("".join(e.itertext()).split())
    first = lambda tag, within=article: next((flat(e) for e in every(tag, within) if flat(e)), None)
    front = next(iter(every("front")), article)
    paragraphs = lambda e: "\n\n".join(filter(None, (flat(p) for p in e.iter() if local(p.tag) in ("p", "title")))) or flat(e)
    abstracts = sorted({paragraphs(a) for a in every("abstract", front)} - {""}, key=lambda t: (len(t), t))
    names = [" ".join(filter(None, (first("given-names", n), first("surname", n)))) for c in every("contrib", front) for n in every("name", c)[:1]]
    ids = {e.get("pub-id-type"): flat(e) for e in every("article-id", front)}
    body = next(iter(every("body")), None)
    years = [flat(y) for d in every("pub-date", front) for y in every("year", d)]
    return {
        "title": first("article-title", front), "abstract": abstracts[0][:ABSTRACT_CHARS] if abstracts else None, "body_text": paragraphs(body)[:BODY_CHARS] if body is not None else None,
        "authors": names or None, "journal": first("journal-title", front), "year": int(years[0]) if years and years[0].isdigit() else None, "pmid": ids.get("pmid"),
        "pmcid": ids.get("pmc") or ids.get("pmcid"), "doi": ids.get("doi"), "language": article.get("{http://www.w3.org/XML/1998/namespace}lang"),
    }


JATS_SCHEMA = "title string, abstract string, body_text string, authors array<string>, journal string, year int, pmid string, pmcid string, doi string, language string, source_file string, error string"


def parse_jats(files: DataFrame) -> DataFrame:
    """Fields of the articles in binary files (path, content); an unreadable one keeps its error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    out.append({**jats_fields(content), "source_file": path, "error": None})
                except Exception as e:
                    out.append({"source_file": path, "error": f"{type(e).__name__}: {e}"})
            table = pd.DataFrame(out, columns=[c.split()[0] for c in JATS_SCHEMA.split(", ")], dtype=object)
            yield table.where(table.notna(), None)

    return files.select("path", "content").mapInPandas(parse, JATS_SCHEMA)


def with_metadata(articles: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata rows left joined with their full text: metadata wins for title, abstract, pmid and doi; the text wins for pmcid and year."""
    m, a = metadata.alias("m"), articles.alias("a")
    j = m.join(a, F.col("m.version_id") == F.col("a.version_id"), "left")
    first = lambda c, x, y: F.coalesce(F.col(f"{x}.{c}"), F.col(f"{y}.{c}")).alias(c)
    return j.select("m.version_id", *(first(c, "m", "a") for c in ("title", "abstract", "pmid", "doi")), *(first(c, "a", "m") for c in ("pmcid", "year")), "a.body_text", "a.authors", "a.journal", "a.language", "m.license_raw")


LABEL_SCHEMA = (
    "source_file string, set_id string, version string, body_text string, sections array<struct<loinc:string,title:string,start:int,end:int>>, "
    "substances array<struct<unii:string,role:string>>, ndcs array<string>, error string"
)


def parse_labels(files: DataFrame) -> DataFrame:
    """Labels of binary files (path, content)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    d = parse_label(content)
                    out.append((path, d["set_id"], d["version"], d["body"], d["sections"], d["substances"], d["ndcs"], None))
                except Exception as e:
                    out.append((path, None, None, None, [], [], [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_file", "set_id", "version", "body_text", "sections", "substances", "ndcs", "error"])

    return files.select("path", "content").mapInPandas(parse, LABEL_SCHEMA)


def label_sidecar(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sections, distinct substances with their product codes) next to the article rows."""
    article = F.concat(F.lit("dailymed:"), "set_id").alias("article_id")
    sections = labels.select(article, F.posexplode("sections").alias("ordinal", "s")).select("article_id", F.col("s.loinc").alias("loinc_code"), "s.title", F.col("s.start").alias("start_offset"), F.col("s.end").alias("end_offset"), "ordinal")
    pairs = labels.select(article, F.explode("substances").alias("s"), F.explode_outer("ndcs").alias("ndc_product"))
    return sections, pairs.select("article_id", "s.unii", "ndc_product", "s.role").dropDuplicates(["article_id", "unii", "ndc_product"])


def newest_labels(labels: DataFrame) -> DataFrame:
    """The highest version of each set id, ties by file."""
    from galenus.operators.load import top_one

    return top_one(labels.filter("set_id is not null"), ["set_id"], F.col("version").try_cast("int").desc_nulls_last(), F.col("source_file"))
