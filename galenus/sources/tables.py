"""Delimited files: variants, compounds, pathways, code lists, registries, id mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File headers.
CODELIST_HEADER = ("Code", "Codelist Code", "Codelist Extensible (Yes/No)", "Codelist Name", "CDISC Submission Value", "CDISC Synonym(s)", "CDISC Definition", "NCI Preferred Term")
CODELIST_COLUMNS = ("code", "codelist_code", "extensible", "name", "submission_value", "synonyms", "definition", "preferred_term")


def _tsv(spark: SparkSession, path: str, schema: str, header: bool = False, mode: str = "PERMISSIVE", sep: str = "\t", quote: str = "") -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", quote).option("escape", "" if not quote else "\\").option("mode", mode).option("enforceSchema", "true")
    return reader.csv(path)


def _headed(spark: SparkSession, path: str, sep: str, **options) -> DataFrame:
    reader = spark.read.option("header", "true").option("sep", sep)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """Variant summary: a dash is a missing value. All columns are text; only those read are kept."""
    raw = _headed(spark, path, "\t", quote="")
    dash = lambda c: F.nullif(F.col(f"`{c}`"), F.lit("-"))
    return raw.select(
        F.col("VariationID").cast("long").alias("variation_id"), dash("Name").alias("name"), dash("ClinicalSignificance").alias("clinical_significance"),
        dash("PhenotypeList").alias("phenotype_list"), dash("RCVaccession").alias("rcv_accession"), F.col("Assembly").alias("assembly"), F.col("_metadata.file_path").alias("source_file"),
    )


def read_compound_property(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A property file keyed by cid. An empty cid is left out, one that is no number fails."""
    raw = _tsv(spark, path, ", ".join(f"{c} string" for c in ("cid", *columns)))
    number = F.when(F.col("cid").rlike(r"^\d+$"), F.col("cid").cast("long")).otherwise(F.raise_error(F.concat(F.lit("cid is no number: "), F.col("cid"))))
    return raw.filter("cid is not null and cid <> ''").select(number.alias("cid"), *columns)


def read_pathways(spark: SparkSession, pathways: str, summations: str, proteins: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pathways, summations, members); malformed rows of the summations are dropped."""
    a = _tsv(spark, pathways, "pathway_id string, name string, species string")
    b = _tsv(spark, summations, "pathway_id string, pathway_name string, summation string", header=True, mode="DROPMALFORMED").select("pathway_id", "summation")
    c = _tsv(spark, proteins, "uniprot_id string, pathway_id string, url string, name string, evidence string, species string").select("uniprot_id", "pathway_id")
    return a, b, c


def read_codelists(spark: SparkSession, path: str) -> DataFrame:
    """Eight text columns with a line number within the file; another header is refused."""
    head = spark.read.text(path).head()
    found = tuple(c.strip().lstrip("﻿") for c in (head[0] if head else "").split("\t"))
    if len(found) != len(CODELIST_HEADER) or found[0] != CODELIST_HEADER[0]:
        raise ValueError(f"unexpected header: {found}")
    raw = _tsv(spark, path, ", ".join(f"{c} string" for c in CODELIST_COLUMNS), header=True)
    return raw.withColumn("line", F.monotonically_increasing_id())  # one file per call: ids rise in file order


def read_registry(spark: SparkSession, path: str, dictionary: dict[str, str]) -> DataFrame:
    """Pipe-delimited export with quoted line feeds; empty is null, and columns that the dictionary calls dates get a typed copy."""
    raw = _headed(spark, path, "|", quote='"', escape='"', multiLine="true", mode="FAILFAST", nullValue="")
    clean = raw.select(*(F.nullif(F.translate(F.col(f"`{c}`"), "\0", ""), F.lit("")).alias(c) for c in raw.columns))
    return clean.select("*", *(F.try_to_date(c, "yyyy-MM-dd").alias(f"{c}_as_date") for c in clean.columns if dictionary.get(c) == "date"))


def compare_columns(found: dict[str, list[str]], dictionary: dict[str, list[str]]) -> dict[str, dict[str, list[str]]]:
    """Tables and columns that only one side has."""
    out = {}
    for t in sorted(set(found) | set(dictionary)):
        a, b = set(found.get(t, ())), set(dictionary.get(t, ()))
        if a != b:
            out[t] = {"only_in_file": sorted(a - b), "only_in_dictionary": sorted(b - a)}
    return out


def read_id_mappings(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (pmid, pmcid, doi); a header line is optional."""
    rows = _tsv(spark, path, "pmid string, pmcid string, doi string", sep=",", quote='"')
    clean = rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in rows.columns)).filter(F.coalesce(F.upper("pmid"), F.lit("")) != "PMID")
    return clean.filter("pmid is not null or pmcid is not null or doi is not null").distinct()


def read_language_codes(spark: SparkSession, path: str) -> DataFrame:
    """Five pipe-separated columns; the terminology code where it differs, else the bibliographic one."""
    rows = _tsv(spark, path, "b string, t string, a2 string, english string, french string", sep="|")
    return rows.select(F.lit("iso639-2").alias("system_key"), F.coalesce(F.nullif(F.trim("t"), F.lit("")), F.trim("b")).alias("code"), F.col("english").alias("label")).filter("code <> ''")


def read_country_codes(spark: SparkSession, path: str) -> DataFrame:
    raw = _headed(spark, path, ",", quote='"')
    names = {c.lower().replace("-", "_").replace(" ", "_"): c for c in raw.columns}
    code, label = names.get("alpha_2", raw.columns[1]), names.get("name", raw.columns[0])
    return raw.select(F.lit("iso3166-1").alias("system_key"), F.upper(F.trim(F.col(f"`{code}`"))).alias("code"), F.col(f"`{label}`").alias("label"))


def oid_rows(text_rows: DataFrame) -> DataFrame:
    """Dotted object identifiers and the words before them, out of text (value)."""
    found = text_rows.select(F.explode(F.regexp_extract_all("value", F.lit(r"([^\n]*?)\s+(\d+(?:\.\d+){5,})"), F.lit(0))).alias("line"))
    return found.select(F.lit("oid").alias("system_key"), F.regexp_extract("line", r"(\d+(?:\.\d+){5,})", 1).alias("code"), F.trim(F.regexp_extract("line", r"^([^\n]*?)\s+\d+(?:\.\d+){5,}", 1)).alias("label"))


def check_codes(codes: DataFrame) -> None:
    """Raises on an empty release or repeated codes."""
    row = codes.agg(F.count("*").alias("n"), F.count_distinct("system_key", "code").alias("d")).head()
    if not row.n:
        raise ValueError("no codes")
    if row.n != row.d:
        raise ValueError(f"{row.n - row.d} repeated codes")
