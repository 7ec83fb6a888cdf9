"""Identifier columns: drug codes, lots, bibliographic ids, digests, versions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_KEY_BYTES = 2000

# Batch entries that say there is no lot, two of them common misspellings.
PLACEHOLDER_LOTS = ("ASKU", "NA", "NI", "NONE", "NOTAVAILABLE", "NOTKNOWN", "NOTREPORTED", "NOTSTATED", "UNK", "UNKNOWN", "UNKNWON", "UNKONWN")


@F.pandas_udf(T.StringType())
def norm_name(s: pd.Series) -> pd.Series:
    """NFKC, case folded, single spaces, stripped. Apply it to distinct names: Spark has neither function built in."""
    return s.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).casefold().split()))


@F.pandas_udf(T.StringType())
def nfkc_upper(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v).upper())


def split_names(cell: Column) -> Column:
    """Parts between ``|`` and ``;``, stripped, without empty ones."""
    return F.filter(F.transform(F.split(cell, "[|;]"), lambda p: F.trim(p)), lambda p: p != "")


def _padded(v: Column, pattern: str, widths: tuple[int, ...]) -> Column:
    # zero padding only ever lengthens: the pattern bounds each segment
    return F.concat(*(F.lpad(F.regexp_extract(v, pattern, i + 1), w, "0") for i, w in enumerate(widths)))


def norm_ndc(code: Column) -> Column:
    """Eleven digits (5-4-2) of a hyphenated code or of eleven digits; else null."""
    v, three = F.trim(code), r"^(\d{1,5})-(\d{1,4})-(\d{1,2})$"
    return F.when(v.rlike(three), _padded(v, three, (5, 4, 2))).when(v.rlike(r"^\d{11}$"), v)


def norm_ndc_product(code: Column) -> Column:
    """Nine digits (5-4): labeler and product of any of the accepted forms; else null."""
    v, two = F.trim(code), r"^(\d{1,5})-(\d{1,4})$"
    return F.coalesce(F.when(v.rlike(two), _padded(v, two, (5, 4))), F.substring(norm_ndc(v), 1, 9), F.when(v.rlike(r"^\d{9}$"), v))


def norm_application_number(number: Column) -> Column:
    """Digits of an application number without its NDA, ANDA or BLA prefix; null if letters are left."""
    v = F.regexp_replace(F.trim(number), r"(?i)^(?:ANDA|NDA|BLA)\s*", "")
    digits = F.regexp_replace(v, r"\D", "")
    return F.when(v.rlike(r"^[\d\s-]+$") & (digits != ""), digits)


def norm_product_key(key: Column) -> Column:
    v, two = F.trim(key), r"^(\d{1,5})-(\d{1,4})$"
    numbered = F.when(v.rlike(r"(?i)^(?:ANDA|NDA|BLA)\s*"), norm_application_number(v))
    return F.when(v != "", F.coalesce(norm_ndc(v), F.when(v.rlike(two), _padded(v, two, (5, 4))), numbered, v))


def norm_lot(lot: Column, unicode: bool = False) -> Column:
    """Upper-case letters and digits only, null if none. ``unicode`` adds compatibility forms, by an Arrow UDF."""
    kept = F.regexp_replace(nfkc_upper(lot) if unicode else F.upper(lot), "[^0-9A-Z]", "")
    return F.when(kept != "", kept)


def is_real_lot(lot: Column) -> Column:
    """False for null and for placeholders."""
    return F.coalesce(~lot.isin(*PLACEHOLDER_LOTS) & (lot != ""), F.lit(False))


def fits_key(text: Column) -> Column:
    return F.octet_length(text) <= MAX_KEY_BYTES


def bare_doi(raw: Column) -> Column:
    """Lower case, without the resolver's address."""
    v = F.lower(F.regexp_replace(F.trim(raw), r"(?i)^https?://(dx\.)?doi\.org/(?=.)", ""))
    return F.when(F.coalesce(raw, F.lit("")) != "", v)


def _positive(digits: Column) -> Column:
    plain = F.regexp_replace(digits, "^0+", "")
    return F.when(plain != "", plain)


def bare_pmid(raw: Column) -> Column:
    """Digits of a record address on the literature host, or of a plain number; else null."""
    v = F.trim(raw)
    at = F.regexp_extract(v, r"(?i)^https?://pubmed\.ncbi\.nlm\.nih\.gov/(\d+)/?$", 1)
    return _positive(F.when(at != "", at).when(v.rlike(r"^\d+$"), v))


def bare_pmcid(raw: Column) -> Column:
    last = F.trim(F.element_at(F.split(F.regexp_replace(F.trim(raw), "/+$", ""), "/"), -1))
    digits = _positive(F.regexp_extract(last, r"(?i)^(?:PMC)?(\d+)$", 1))
    return F.when(digits.isNotNull(), F.concat(F.lit("PMC"), digits))


def normalize_orcid(raw: Column) -> Column:
    """Four dashed groups from an address or a bare id; else null."""
    p = r"(?i)(?:^|/)\s*(\d{4})-?(\d{4})-?(\d{4})-?(\d{3}[\dX])\s*/?$"
    v = F.trim(raw)
    return F.when(v.rlike(p), F.upper(F.concat_ws("-", *(F.regexp_extract(v, p, i) for i in range(1, 5)))))


def orcid_check_ok(orcid: Column) -> Column:
    """ISO 7064 mod 11-2 of the dashed form."""
    digits = F.translate(orcid, "-", "")
    total = F.aggregate(F.split(F.substring(digits, 1, 15), ""), F.lit(0), lambda t, d: (t + d.cast("int")) * 2)
    rest = (12 - total % 11) % 11
    return F.when(digits.rlike(r"^\d{15}[\dX]$"), F.substring(digits, 16, 1) == F.when(rest == 10, "X").otherwise(rest.cast("string"))).otherwise(F.lit(False))


def composite_md5(*parts: Column) -> Column:
    """Digest of parts joined by the unit separator; a null part is empty."""
    return F.md5(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def version_rank(version: Column) -> Column:
    """Dotted version as an array that sorts numbers by value and above text."""
    return F.transform(F.split(F.coalesce(version, F.lit("")), r"\."), lambda p: F.struct(
        F.when(p.rlike(r"^\d+$"), 1).otherwise(0).alias("numeric"), F.coalesce(p.try_cast("bigint"), F.lit(0).cast("bigint")).alias("number"), p.alias("text")
    ))
