"""The registered queries of this package, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from galenus.llm import decontamination, html, language, licenses, media, packing, pii, secrets, simhash, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": lambda s, d: pii.find_personal_data(_table(s, d, "documents")),
        "op2_licenses": lambda s, d: licenses.license_scan(_table(s, d, "documents")),
        "op3_simhash": lambda s, d: simhash.near_duplicates(_table(s, d, "documents")),
        "op4_media": lambda s, d: media.media_features(_table(s, d, "documents")),
        "op5_packing": lambda s, d: packing.pack(_table(s, d, "documents")),
        "op6_toxicity": lambda s, d: toxicity.severity(_table(s, d, "documents"), _table(s, d, "labels")),
        "op7_html": lambda s, d: html.extract_main_text(_table(s, d, "pages")),
        "op8_decontamination": lambda s, d: decontamination.contamination(_table(s, d, "documents"), _table(s, d, "benchmark")),
        "op9_language": lambda s, d: language.identify_languages(_table(s, d, "documents")),
        "op10_secrets": lambda s, d: secrets.find_secrets(_table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licenses": licenses.oracle(),
        "op8_decontamination": decontamination.ORACLE,
        "op10_secrets": secrets.oracle(),
    }
