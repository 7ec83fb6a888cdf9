"""From parsed fields to finished article rows, and the single-source builders of serialised records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galenus.functions import ids, licences, sentences, text
from galenus.schemas import ARTICLE

PUBLIC_DOMAIN = "public_domain"
LIST_COLUMNS = ("authors", "mesh", "publication_types")


def article_types() -> dict[str, str]:
    return {c.strip().split(" ", 1)[0]: c.strip().split(" ", 1)[1] for c in ARTICLE.split(", ")}


def finalize(rows: DataFrame) -> DataFrame:
    """The 32 article columns from whatever of them ``rows`` has: lists capped, text, status, notes, hash and defaults filled.

    A text, status or licence that is already set stays. Types are those of
    ARTICLE, so shards of different sources union by name.
    """
    types = article_types()
    have = set(rows.columns)
    col = lambda c: F.col(c).cast(types[c]) if c in have else F.lit(None).cast(types[c])
    rows = rows.select(*(col(c).alias(c) for c in types))
    for c in LIST_COLUMNS:
        rows = rows.withColumn(c, F.transform(c, text.cap_element))
    rows = rows.withColumn("text", F.coalesce("text", text.build_text(F.col("title"), F.col("abstract"), F.col("body_text"))))
    has_id = sum((F.coalesce(F.col(c), F.lit("")) != "").cast("int") for c in ("id", "pmid", "pmcid", "doi")) > 0
    status = text.extract_status(F.col("text"), F.col("abstract"), F.col("body_text"), has_id, F.col("book_meta").isNotNull())
    rows = rows.withColumn("_status", status)
    set_before = F.col("extract_status").isNotNull()
    rows = rows.withColumn("extract_notes", F.when(set_before, F.col("extract_notes")).otherwise(F.col("_status.notes")))
    rows = rows.withColumn("extract_status", F.coalesce("extract_status", "_status.status"))
    rows = rows.withColumn("content_hash", text.content_hash(F.col("text"))).withColumn("is_retracted", F.coalesce("is_retracted", F.lit(False)))
    rows = rows.withColumn("license", F.coalesce("license", licences.licence_code(F.col("license_raw"))))
    rows = rows.withColumn("license_url", F.coalesce("license_url", licences.licence_url(F.col("license_raw"))))
    return rows.withColumn("subset", F.coalesce("subset", licences.subset_of(F.col("license")))).select(*types)


def split_hot_body(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(narrow metadata, wide text) on the same id. The body keeps an override only where the joined parts do not give the text."""
    parts = [F.col(c) for c in ("title", "abstract", "body_text")]
    body = articles.select(F.col("id").alias("article_id"), "title", "abstract", "body_text", text.text_override(F.col("text"), *parts).alias("text_override"))
    return articles.drop("title", "abstract", "body_text", "text"), body


def join_hot_body(hot: DataFrame, body: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in ("title", "abstract", "body_text")]
    b = body.withColumn("text", text.virtual_text(F.col("text_override"), *parts)).drop("text_override")
    return hot.join(b, hot.id == b.article_id).drop("article_id")


def _source_rows(df: DataFrame, source: str, native: Column, sentence: Column, source_file: str, licence_raw: str, public: bool, **more: Column) -> DataFrame:
    """Rows without a native id are dropped, never given one."""
    rows = df.filter(native.isNotNull() & (native.cast("string") != "")).select(
        F.concat_ws(":", F.lit(source), native.cast("string")).alias("id"), F.lit(source).alias("source"), F.lit(source_file).alias("source_file"),
        native.cast("string").alias("source_record_id"), sentence.alias("text"), F.lit(licence_raw).alias("license_raw"),
        *([F.lit(PUBLIC_DOMAIN).alias("license")] if public else []), *(c.alias(k) for k, c in more.items()),
    )
    return finalize(rows)


def bioactivity_articles(activities: DataFrame, molecules: DataFrame, structures: DataFrame, assays: DataFrame, targets: DataFrame, source_file: str, licence_raw: str = "CC BY-SA 3.0") -> DataFrame:
    """Five-way left join; unmatched dimensions leave their clause out. Dimensions join on their own keys, so AQE may broadcast them."""
    j = activities.join(molecules, "molregno", "left").join(structures, "molregno", "left").join(assays, "assay_id", "left").join(targets, "tid", "left")
    c = F.col
    sentence = sentences.bioactivity(c("chembl_id"), c("canonical_smiles"), c("standard_type"), c("standard_relation"), c("standard_value"), c("standard_units"), c("target_name"), c("organism"), c("description"))
    return _source_rows(j, "chembl", c("activity_id"), sentence, source_file, licence_raw, False)


def preferred_assembly(variants: DataFrame) -> DataFrame:
    """One row per variation: GRCh38, GRCh37, NCBI36, others; ties by the remaining columns."""
    order = F.when(F.col("assembly") == "GRCh38", 0).when(F.col("assembly") == "GRCh37", 1).when(F.col("assembly") == "NCBI36", 2).otherwise(3)
    w = Window.partitionBy("variation_id").orderBy(order, "assembly", "rcv_accession", "name")
    return variants.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def variant_articles(variants: DataFrame, source_file: str) -> DataFrame:
    c = F.col
    sentence = sentences.variant(c("variation_id"), c("name"), c("clinical_significance"), c("phenotype_list"), c("rcv_accession"))
    return _source_rows(preferred_assembly(variants), "clinvar", c("variation_id"), sentence, source_file, "public domain", True, title=c("name"))


def merge_compounds(smiles: DataFrame, iupac: DataFrame, titles: DataFrame, masses: DataFrame) -> DataFrame:
    """Left sort-merge joins of three property files onto the primary one, by cid."""
    out = smiles
    for side in (iupac, titles, masses):
        out = out.join(side.hint("merge"), "cid", "left")
    return out


def compound_articles(compounds: DataFrame, source_file: str) -> DataFrame:
    c = F.col
    sentence = sentences.compound(c("cid"), c("smiles"), c("iupac_name"), c("title"), c("formula"))
    return _source_rows(compounds, "pubchem", c("cid"), sentence, source_file, "public domain", True, title=c("title"))


def increasing_or_raise(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Rows with a check that ``key`` rises strictly in file order; a violation fails the job. Use one file per ``source_file``."""
    w = Window.partitionBy("source_file").orderBy(position)
    before = F.lag(key).over(w)
    checked = F.when(before >= F.col(key), F.raise_error(F.concat(F.lit(f"{key} is not rising at "), F.col(position).cast("string")))).otherwise(F.lit(True))
    return rows.withColumn("_ok", checked).filter("_ok is not null").drop("_ok")


def pathway_table(pathways: DataFrame, summations: DataFrame, proteins: DataFrame, sample: int = 5) -> DataFrame:
    """Pathways with their first summation and the first members by name, and the members' true number."""
    first = summations.groupBy("pathway_id").agg(F.min("summation").alias("summation"))
    pairs = proteins.select("pathway_id", "uniprot_id").distinct()
    w = Window.partitionBy("pathway_id").orderBy("uniprot_id")
    ranked = pairs.withColumn("k", F.row_number().over(w))
    members = ranked.groupBy("pathway_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= sample, F.col("uniprot_id")))), ", ").alias("proteins_sample"), F.count("*").alias("n_proteins")
    )
    out = pathways.join(first, "pathway_id", "left").join(members, "pathway_id", "left")
    return out.withColumn("n_proteins", F.coalesce("n_proteins", F.lit(0).cast("long")))


def pathway_articles(table: DataFrame, source_file: str) -> DataFrame:
    c = F.col
    sentence = sentences.pathway(c("name"), c("species"), c("summation"), c("proteins_sample"), c("n_proteins"))
    return _source_rows(table, "reactome", c("pathway_id"), sentence, source_file, "CC BY 4.0", False, title=c("name"))


def descriptor_articles(descriptors: DataFrame, source_file: str) -> DataFrame:
    c = F.col
    return _source_rows(descriptors, "mesh", c("descriptor_ui"), sentences.descriptor(c("name"), c("scope_note")), source_file, "public domain", True, title=c("name"))


def protein_articles(proteins: DataFrame, source_file: str) -> DataFrame:
    c = F.col
    sentence = sentences.protein(c("entry_name"), c("description"), c("organism"), c("gene"), c("sequence"))
    return _source_rows(proteins, "uniprot", c("accession"), sentence, source_file, "CC BY 4.0", False, title=c("description"))


def term_articles(terms: DataFrame, source_file: str, licence_raw: str | None) -> DataFrame:
    c = F.col
    return _source_rows(terms, "ontologies", c("id"), sentences.term(c("name"), c("definition")), source_file, licence_raw or "", False, title=c("name"))


def work_articles(works: DataFrame, source_file: str) -> DataFrame:
    """Open works: ids normalised, abstract from its inverted index, subject names once each in order."""
    from galenus.functions.json import inverted_index_text

    c = F.col
    rows = works.select(
        F.concat(F.lit("openalex:"), F.element_at(F.split("id", "/"), -1)).alias("id"), F.lit("openalex").alias("source"), F.lit(source_file).alias("source_file"),
        F.element_at(F.split("id", "/"), -1).alias("source_record_id"), ids.bare_pmid(c("ids.pmid")).alias("pmid"), ids.bare_pmcid(c("ids.pmcid")).alias("pmcid"),
        ids.bare_doi(c("doi")).alias("doi"), c("title"), inverted_index_text(c("abstract_inverted_index")).alias("abstract"), c("publication_year").alias("year"),
        c("language"), F.array_distinct(F.transform("mesh", lambda m: m["descriptor_name"])).alias("mesh"),
        F.transform("authorships", lambda a: a["author"]["display_name"]).alias("authors"),
        c("primary_location.source.display_name").alias("journal"), c("primary_location.license").alias("license_raw"), c("is_retracted"),
    )
    return finalize(rows.filter("id is not null"))


def is_biomedical(concepts: Column, roots: tuple[str, ...]) -> Column:
    """A level-0 concept whose id ends in one of ``roots``."""
    return F.coalesce(F.exists(concepts, lambda k: (k["level"] == 0) & F.element_at(F.split(k["id"], "/"), -1).isin(*roots)), F.lit(False))


def codelist_parts(rows: DataFrame, package: str, release: str, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """(one row per codelist and part of at most ``most`` terms, counters). ``rows`` are the eight file columns with a line number.

    Header rows have no codelist code; a term attaches to its header wherever
    that stands. Terms without a header and rows without a code are counted.
    """
    coded = rows.withColumn("code", F.trim("code")).withColumn("codelist_code", F.coalesce(F.trim("codelist_code"), F.lit("")))
    usable = coded.filter("code <> ''")
    heads = usable.filter("codelist_code = ''").select(F.col("code").alias("list"), F.col("name").alias("list_name"), F.col("submission_value").alias("list_value"), F.col("definition").alias("list_definition"))
    terms = usable.filter("codelist_code <> ''")
    orphans = terms.join(heads, terms.codelist_code == heads.list, "left_anti").agg(F.count("*").alias("orphan_terms"))
    counters = coded.agg(F.count_if((F.col("code") == "") | F.col("code").isNull()).alias("skipped_no_id")).crossJoin(orphans)
    w = Window.partitionBy("list").orderBy("line")
    joined = heads.join(terms, heads.list == terms.codelist_code, "left")
    joined = joined.withColumn("part", F.floor((F.row_number().over(w) - 1) / most).cast("int") + 1)
    line = F.concat_ws("; ", F.concat_ws(": ", "submission_value", "preferred_term"), F.nullif(F.col("synonyms"), F.lit("")), F.nullif(F.col("definition"), F.lit("")))
    parts = joined.groupBy("list", "list_name", "list_value", "list_definition", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("line", line.alias("text"))))), lambda t: t["text"]), "\n").alias("terms"),
        F.count("code").alias("n_terms"),
    )
    total = Window.partitionBy("list")
    parts = parts.withColumn("n_parts", F.max("part").over(total))
    title = F.when(F.col("n_parts") > 1, F.format_string("%s (part %d of %d)", "list_name", "part", "n_parts")).otherwise(F.col("list_name"))
    head = F.concat_ws(" ", F.concat(F.lit(f"CDISC codelist ({package}, {release}): "), "list_name"), F.concat(F.lit("("), "list_value", F.lit(").")), "list_definition")
    out = parts.select(
        F.concat_ws(":", F.lit("cdisc_ct"), F.lit(package), "list", F.concat(F.lit("p"), F.col("part").cast("string"))).alias("id"), title.alias("title"),
        F.concat_ws("\n", head, F.nullif(F.col("terms"), F.lit(""))).alias("text"), "n_terms", "part", "n_parts",
    )
    return out, counters


def document_articles(documents: DataFrame, source_file: Column, licence_raw: str) -> DataFrame:
    """Regulator documents (id, name, type, url, product_number, medicine_name, first_published, last_updated, text) as
    articles. The status is set here, since book_meta would make them book rows: ok with text, else empty."""
    body = F.when(F.trim(F.coalesce("text", F.lit(""))) != "", F.col("text"))
    meta = F.to_json(F.struct(F.col("type").alias("doc_type"), F.col("id").alias("document_id"), "medicine_name", F.col("first_published").alias("first_published_date"), F.col("last_updated").alias("last_updated_date")), {"ignoreNullFields": "false"})
    rows = documents.select(
        F.concat_ws(":", F.lit("epar"), "id").alias("id"), F.lit("epar").alias("source"), source_file.alias("source_file"), F.nullif("product_number", F.lit("")).alias("source_record_id"),
        F.coalesce(F.nullif("name", F.lit("")), F.concat(F.lit("EPAR document "), "id")).alias("title"), body.alias("body_text"), F.nullif(F.regexp_extract("first_published", r"^(\d{4})", 1), F.lit("")).cast("int").alias("year"),
        F.lit("en").alias("language"), F.lit("permissive").alias("license"), F.lit(licence_raw).alias("license_raw"), F.col("url").alias("pdf_url"), meta.alias("book_meta"),
        F.when(body.isNotNull(), "ok").otherwise("empty").alias("extract_status"),
    )
    return finalize(rows)
