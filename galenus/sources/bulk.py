"""Bulk files of many full-text articles, and archives of manuscripts, as rows with the reason of what is left out."""

from __future__ import annotations

import gzip
import itertools
import re
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galenus.functions.markup import local
from galenus.sources.archives import read_members
from galenus.sources.xml import BODY_CHARS, JATS_SCHEMA, jats_fields, parse_jats

# Forms of record numbers, and the licence of manuscript archives.
PREPRINT_ID, PMC_ID = re.compile(r"PPR\d+"), r"PMC\d+"
MANUSCRIPT_LICENCE, MANUSCRIPT_SUBSET = "text mining / applicable copyright", "text_mining"
BULK_SCHEMA = f"position int, preprint_id string, license_raw string, {JATS_SCHEMA}"
XLINK = "{http://www.w3.org/1999/xlink}href"


def articles_of(source) -> Iterator[ET.Element]:
    """Each outermost <article> of a file, freed once the next is asked for; one inside another is part of it."""
    root, depth = None, 0
    for event, el in ET.iterparse(source, events=("start", "end")):
        root = el if root is None else root
        if local(el.tag) != "article":
            continue
        depth += 1 if event == "start" else -1
        if event == "end" and depth == 0:
            yield el
            root.clear()


def preprint_id(article: ET.Element) -> str | None:
    """The record number: as an id of the archive, else as any other id."""
    ids = [((e.get("pub-id-type") or "").lower(), (e.text or "").strip()) for e in article.iter() if local(e.tag) == "article-id"]
    found = [(kind != "archive", n, value) for n, (kind, value) in enumerate(ids) if PREPRINT_ID.fullmatch(value)]
    return min(found)[2] if found else None


def licence_text(article: ET.Element) -> str | None:
    """The first licence's text of at most 500 characters, led by the first address of a licence if the text has none."""
    held = [e for e in article.iter() if local(e.tag) in ("license", "license-p")]
    text = next((t for e in held if (t := " ".join("".join(e.itertext()).split())[:500])), "")
    link = next((u for e in held if (u := e.get(XLINK) or e.get("href"))), "")
    return (f"{link} {text}".strip() if link and "://" not in text else text) or None


def _opened(content: bytes):
    import io

    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def parse_bulk(files: DataFrame) -> DataFrame:
    """Every article of binary files (path, content; plain or gzip) with its position; a damaged file ends with an error row."""
    names = [c.split()[0] for c in BULK_SCHEMA.split(", ")]

    def rows(path: str, content: bytes) -> Iterator[dict]:
        n = 0
        try:
            for n, a in enumerate(articles_of(_opened(content)), 1):
                own = {"source_file": path, "position": n, "preprint_id": preprint_id(a), "license_raw": licence_text(a), "error": None}
                yield {**jats_fields(ET.tostring(a)), **own}
        except (ET.ParseError, OSError, EOFError) as e:
            yield {"source_file": path, "position": n + 1, "error": f"{type(e).__name__}: {e}"}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                found = rows(path, content)
                while cut := list(itertools.islice(found, 200)):
                    table = pd.DataFrame(cut, columns=names, dtype=object)
                    yield table.where(table.notna(), None)

    return files.select("path", "content").mapInPandas(parse, BULK_SCHEMA)


def preprints(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable articles with their id, counts of the others by file and reason).

    An article needs a record number and an abstract or a body; of those with one
    id in a file the first counts. The id is the DOI's if there is one.
    """
    ident = F.coalesce(F.concat(F.lit("doi:"), "doi"), F.concat(F.lit("preprint:"), "preprint_id"))
    bare = F.col("body_text").isNull() & F.col("abstract").isNull()
    reason = F.when(F.col("error").isNotNull(), "damaged").when(F.col("preprint_id").isNull(), "no_ppr_id").when(bare, "no_text")
    marked = articles.withColumn("id", ident).withColumn("reason", reason)
    again = F.row_number().over(Window.partitionBy("source_file", "reason", "id").orderBy("position")) > 1
    marked = marked.withColumn("reason", F.coalesce("reason", F.when(again, "duplicate_id")))
    return marked.filter("reason is null").drop("reason", "error"), marked.filter("reason is not null").groupBy("source_file", "reason").count()


def manuscripts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of manuscript archives: a .txt member's text is the body, an .xml member is a full-text article.

    The id ends with the format, since archives of both forms hold the same
    manuscripts. The body is cut at BODY_CHARS as in every full text.
    """
    members = read_members(spark, path).filter("content is not null")
    number = F.nullif(F.regexp_extract(F.regexp_extract("member", r"[^/]+$", 0), PMC_ID, 0), F.lit(""))
    form = F.lower(F.regexp_extract("member", r"\.([A-Za-z]+)$", 1))
    shared = members.withColumn("pmcid", number).withColumn("form", form).filter(F.col("form").isin("txt", "xml"))
    where = F.concat_ws("!", "source_file", "member")
    texts = shared.filter("form = 'txt'").select(where.alias("at"), F.substring(F.decode("content", "UTF-8"), 1, BODY_CHARS).alias("body_text"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("abstract"))
    parsed = parse_jats(shared.filter("form = 'xml'").select(where.alias("path"), "content")).select(F.col("source_file").alias("at"), "body_text", "title", "abstract")
    about = shared.select(where.alias("at"), "source_file", "member", "pmcid", "form")
    ident = F.concat_ws(":", F.lit("manuscript"), F.coalesce(F.concat_ws(":", "pmcid", F.when(F.col("pmcid").isNotNull(), F.col("form"))), F.lit("")))
    named = F.when(F.col("pmcid").isNotNull(), ident).otherwise(F.concat_ws(":", F.lit("manuscript"), "source_file", "member"))
    rows = about.join(texts.unionByName(parsed), "at")
    return rows.select(
        named.alias("id"), F.lit("manuscript").alias("source"), "source_file", F.col("pmcid").alias("source_record_id"), "pmcid", "title", "abstract", F.nullif("body_text", F.lit("")).alias("body_text"),
        F.lit(MANUSCRIPT_LICENCE).alias("license_raw"), F.lit(MANUSCRIPT_SUBSET).alias("subset"), F.lit(True).alias("is_manuscript"),
    )
