"""Regulator documents: selection, newest version, and text of PDF files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.operators.load import top_one

MAX_PAGES, MAX_BYTES = 2000, 200 << 20


def select_documents(rows: DataFrame, types: tuple[str, ...], prefix: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, refusals by reason): the type is wanted, the id is a number, the address stands under the prefix."""
    reason = (
        F.when(~F.coalesce(F.col("type").isin(*types), F.lit(False)), "type").when(~F.coalesce(F.col("id").cast("string").rlike(r"^\d+$"), F.lit(False)), "id").when(~F.coalesce(F.col("url").startswith(prefix), F.lit(False)), "url")
    )
    marked = rows.withColumn("_reason", reason)
    return marked.filter("_reason is null").drop("_reason"), marked.filter("_reason is not null").groupBy(F.col("_reason").alias("reason")).count()


def newest_documents(rows: DataFrame) -> DataFrame:
    """The last updated row of each id, ties to the first position."""
    return top_one(rows, ["id"], F.col("last_updated").desc_nulls_last(), F.col("position"))


def pdf_text(files: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """(path, text, error) of binary PDF files (path, content); needs pypdf on the executors, else each row says so."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    import io

                    import pypdf

                    if len(content) > MAX_BYTES:
                        raise ValueError("too large")
                    pages = pypdf.PdfReader(io.BytesIO(content)).pages[:max_pages]
                    out.append((path, "\n\n".join(p.extract_text() or "" for p in pages), None))
                except Exception as e:
                    out.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "text", "error"], dtype=object)

    return files.select("path", "content").mapInPandas(read, "path string, text string, error string")
