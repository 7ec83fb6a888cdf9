"""Line and stanza formats: sequence files, ontologies, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.sources.files import is_qa_shaped

BODY_KEYS = ("text", "content", "body", "answer", "output", "passage", "abstract")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One row per sequence record: accession, entry_name, description, organism, gene, sequence. A malformed header fails."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v"), F.col("_metadata.file_path").alias("source_file")).filter("trim(v) <> ''")
    head = F.regexp_extract("v", r"^([^\r\n]*)", 1)
    parts = raw.select(head.alias("head"), F.regexp_replace(F.regexp_replace("v", r"^[^\r\n]*", ""), r"\s+", "").alias("sequence"), "source_file")
    shape = r"^[^|]*\|\s*([^|\s]+)\s*\|\s*(\S+)\s*(.*)$"
    checked = F.when(F.col("head").rlike(shape), F.col("head")).otherwise(F.raise_error(F.concat(F.lit("malformed header: "), "head")))
    parts = parts.withColumn("head", checked).withColumn("rest", F.regexp_extract("head", shape, 3))
    mark = lambda k, default: F.coalesce(F.nullif(F.trim(F.regexp_extract("rest", rf"(?:^|\s){k}=(.*?)(?=\s(?:OS|OX|GN|PE|SV)=|$)", 1)), F.lit("")), F.lit(default))
    return parts.select(
        F.regexp_extract("head", shape, 1).alias("accession"), F.regexp_extract("head", shape, 2).alias("entry_name"),
        F.trim(F.regexp_replace("rest", r"(?:^|\s)(?:OS|OX|GN|PE|SV)=.*$", "")).alias("description"), mark("OS", "Unknown organism").alias("organism"), mark("GN", "Unknown gene").alias("gene"), "sequence", "source_file",
    )


def read_obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(terms: id, name, definition, is_obsolete; header: licence) of stanzas between blank lines."""
    stanzas = spark.read.option("lineSep", "\n\n").text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    tag = lambda k: F.nullif(F.regexp_extract("value", rf"(?m)^{k}: ([^\r\n]*)", 1), F.lit(""))
    quoted = F.regexp_replace(F.regexp_extract("value", r'(?m)^def: "((?:[^"\\]++|\\.)*+)"', 1), r"\\(.)", "$1")
    terms = stanzas.filter(F.col("value").rlike(r"^\s*\[Term\]")).select(
        tag("id").alias("id"), tag("name").alias("name"), F.nullif(quoted, F.lit("")).alias("definition"), F.coalesce(tag("is_obsolete") == "true", F.lit(False)).alias("is_obsolete"), "source_file"
    )
    header = stanzas.filter(F.col("value").startswith("format-version")).select(F.nullif(F.regexp_extract("value", r"(?m)^property_value: \S*license\S* \"?([^\"\r\n]+?)\"?(?: xsd:\S+)?$", 1), F.lit("")).alias("licence"), "source_file")
    return terms.filter("id is not null"), header


def read_json_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records with a declared schema, count of bad lines) of a JSON-lines file; a bad line is counted, not raised."""
    lines = spark.read.text(path).filter("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("source_file"))
    parsed = lines.select(F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"), "source_file")
    good = parsed.filter("r._corrupt is null").select("r.*", "source_file").drop("_corrupt")
    return good, parsed.agg(F.count_if(F.col("r._corrupt").isNotNull()).alias("bad_lines"))


def read_multilingual(spark: SparkSession, path: str, least_chars: int = 50) -> tuple[DataFrame, DataFrame]:
    """(rows, drop counts) of JSON lines with a body under any of BODY_KEYS, a language and an id.

    A missing language comes from the file name's code, a missing id from a
    digest of file and text.
    """
    schema = ", ".join(f"{k} string" for k in ("id", "lang", "language", "title", *BODY_KEYS))
    raw = spark.read.schema(schema).json(path).select("*", F.col("_metadata.file_name").alias("source_file"))
    body = F.trim(F.coalesce(*(F.nullif(F.trim(k), F.lit("")) for k in BODY_KEYS)))
    lang = F.coalesce(F.lower("lang"), F.lower("language"), F.nullif(F.regexp_extract("source_file", r"(?:^|[_.-])([a-z]{2})(?=[_.-])", 1), F.lit("")))
    rows = raw.select(F.coalesce("id", F.sha1(F.concat_ws(":", "source_file", F.substring(body, 1, 200)))).alias("id"), lang.alias("language"), "title", body.alias("body_text"), "source_file")
    reason = F.when(F.coalesce("body_text", F.lit("")) == "", "no_text").when(F.char_length("body_text") < least_chars, "too_short")
    marked = rows.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null").groupBy("reason").count()


def read_guidelines(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a guideline file, its columns found by candidate names; None for question-answer data. A literal None is null."""
    raw = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.json(path)
    if is_qa_shaped(raw.columns):
        return None
    low = {c.lower(): c for c in raw.columns}

    def pick(*names: str):
        at = next((low[n] for n in names if n in low), None)
        return F.nullif(F.col(f"`{at}`").cast("string"), F.lit("None")) if at else F.lit(None).cast("string")

    return raw.select(pick("id", "doc_id").alias("id"), pick("source", "publisher").alias("publisher"), pick("title", "name").alias("title"), pick("clean_text", "text", "content").alias("body_text"), pick("url", "link").alias("url"))
