"""Licence columns: a normalised code, its URL, and the subset that the code allows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence identifiers that count as permissive, in normalised form.
PERMISSIVE = (
    "apache", "apache 2", "apache-2", "apache 2.0", "apache-2.0", "apache2", "apache license", "apache license 2.0", "apache license version 2.0",
    "apache license, version 2.0", "apache software license", "mit", "mit-0", "mit license", "mit no attribution", "bsd", "0bsd", "bsd-2-clause",
    "bsd-3-clause", "bsd 2-clause", "bsd 3-clause", "bsd-2", "bsd-3", "bsd license", "bsd 2-clause license", "bsd 3-clause license", "isc", "isc license",
)
COMMERCIAL = ("CC0", "CC BY", "CC BY-SA", "CC BY-ND", "permissive", "public_domain")
URL = r"(?i)https?://creativecommons\.org/(?:licenses|publicdomain)/[^\s)\"']+"


def licence_key(raw: Column) -> Column:
    """Lower case, single spaces, without outer punctuation."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(raw, r"(?U)\s+", " "))), r"^[ .;,\"'()\[\]]+|[ .;,\"'()\[\]]+$", "")


def licence_code(raw: Column) -> Column:
    """The first arm that fits: non-commercial before share-alike before plain attribution; unknown if none does."""
    u = F.upper(raw)
    has = lambda *subs: F.expr("false") if not subs else [F.contains(u, F.lit(s)) for s in subs]

    def any_of(*subs: str) -> Column:
        out = F.lit(False)
        for c in has(*subs):
            out = out | c
        return out

    return F.coalesce(
        F.when(F.coalesce(F.trim(raw), F.lit("")) == "", "unknown")
        .when(u.rlike(r"\bCC0\b") | any_of("CC-0"), "CC0")
        .when(F.contains(F.translate(u, " ", ""), F.lit("BY-NC-ND")), "CC BY-NC-ND")
        .when(any_of("BY-NC-SA"), "CC BY-NC-SA")
        .when(any_of("BY-NC"), "CC BY-NC")
        .when(any_of("BY-SA"), "CC BY-SA")
        .when(any_of("BY-ND"), "CC BY-ND")
        .when(u.rlike(r"\bCC\s*BY\b") | any_of("CREATIVE COMMONS ATTRIBUTION"), "CC BY")
        .when(raw.rlike(r"(?i)creativecommons\.org/licenses/by/"), "CC BY")
        .when(raw.rlike(r"(?i)creativecommons\.org/publicdomain/zero/"), "CC0")
        .when(any_of("TEXT MINING", "TEXT-MINING", "FAIR USE"), "text_mining")
        .when(licence_key(raw).isin(*PERMISSIVE), "permissive"),
        F.lit("unknown"),
    )


def licence_url(raw: Column) -> Column:
    found = F.regexp_extract(raw, URL, 0)
    return F.when(found != "", F.regexp_replace(found, r"[.,;]+$", ""))


def normalize_licence(raw: Column) -> Column:
    """Struct (license, license_url, license_raw); the raw text is cut at 300 characters."""
    blank = F.coalesce(F.trim(raw), F.lit("")) == ""
    return F.struct(licence_code(raw).alias("license"), F.when(~blank, licence_url(raw)).alias("license_url"), F.when(~blank, F.substring(F.trim(raw), 1, 300)).alias("license_raw"))


def subset_of(code: Column, default: str = "open_metadata") -> Column:
    return F.when(code.isin(*COMMERCIAL), "commercial").when(code.startswith("CC BY-NC") | (code == "text_mining"), "text_mining").otherwise(default)


def is_commercial(code: Column) -> Column:
    """Whether an article's licence code allows commercial use: CC0, CC BY-SA, CC BY-ND, and CC BY without an NC."""
    v = F.upper(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(code, F.lit("")), "_", " "), r"\s+", " ")))
    return v.startswith("CC0") | v.rlike("^CC BY[- ](?:SA|ND)") | (v.startswith("CC BY") & ~F.contains(v, F.lit("NC")))
