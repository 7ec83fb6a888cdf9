"""Text columns: normalising, joining, status, hashes, words, shingles and n-grams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_OK_CHARS = 200
BLANK = " \t\r\n"


def normalize_whitespace(text: Column) -> Column:
    """NUL becomes a space, runs of spaces and tabs one space, three or more line feeds two; outer white space goes."""
    flat = F.regexp_replace(F.regexp_replace(F.translate(text, "\0", " "), "[ \t]+", " "), "\n{3,}", "\n\n")
    return F.regexp_replace(flat, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """Null, or only space, tab, carriage return and line feed."""
    return F.coalesce(F.translate(text, BLANK, "") == "", F.lit(True))


def join_parts(*parts: Column) -> Column:
    """The non-blank parts joined by a blank line; null if all are blank."""
    joined = F.concat_ws("\n\n", *(F.when(~is_blank(p), p) for p in parts))
    return F.when(joined != "", joined)


def build_text(title: Column, abstract: Column, body: Column) -> Column:
    return normalize_whitespace(F.coalesce(join_parts(title, abstract, body), F.lit("")))


def virtual_text(override: Column, *parts: Column) -> Column:
    """An empty override means no text; otherwise the override, or else the joined parts."""
    return F.when(override == "", F.lit(None)).otherwise(F.coalesce(override, join_parts(*parts)))


def text_override(text: Column, *parts: Column) -> Column:
    """What ``virtual_text`` needs to give ``text`` back: null if that is the join of the parts."""
    return F.when(text.eqNullSafe(join_parts(*parts)), F.lit(None)).otherwise(F.coalesce(text, F.lit("")))


def extract_status(text: Column, abstract: Column, body: Column, has_id: Column, is_book: Column | None = None) -> Column:
    """Struct (status, notes): ok, partial, empty or dropped by the 200-character rule."""
    n = F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""))
    has = lambda c: F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))
    some = has(abstract) | has(body)
    pair = lambda s, note: F.struct(F.lit(s).alias("status"), note.cast("string").alias("notes"))
    none = F.lit(None)
    book = F.when(n >= MIN_OK_CHARS, pair("ok", none)).otherwise(pair("partial", F.concat(F.lit("book_row_short_text_len="), n.cast("string"))))
    plain = (
        F.when((n == 0) & ~some & has_id, pair("empty", F.lit("no_title_abstract_body")))
        .when((n == 0) & ~some, pair("dropped", F.lit("no_id_no_text")))
        .when(some | (n >= MIN_OK_CHARS), pair("ok", none))
        .otherwise(pair("partial", F.concat(F.lit("short_text_len="), n.cast("string"))))
    )
    return plain if is_book is None else F.when(is_book, book).otherwise(plain)


def content_hash(text: Column) -> Column:
    """SHA-256 of the text; null for an empty one."""
    return F.when(text != "", F.sha2(text, 256))


def cap_element(text: Column, most_bytes: int = 2000) -> Column:
    """Cut to ``most_bytes`` UTF-8 bytes on a character boundary, with an ellipsis inside that limit."""
    room = most_bytes - 3
    raw = text.cast("binary")
    # step back over continuation bytes (10xxxxxx) at the cut
    back = lambda k: F.conv(F.hex(F.substring(raw, room - k + 1, 1)), 16, 10).cast("int")
    cut = F.lit(room)
    for k in range(3):
        cut = F.when((cut == room - k) & back(k).between(128, 191), room - k - 1).otherwise(cut)
    return F.when(F.octet_length(text) <= most_bytes, text).otherwise(F.concat(F.decode(raw.substr(F.lit(1), cut), "UTF-8"), F.lit("…")))


def row_bytes(columns: list[Column], overhead: int = 64) -> Column:
    """Estimated size of a row: the UTF-8 bytes of its string columns and an overhead."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(overhead))


def words(text: Column) -> Column:
    """Lower-case Unicode words."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w+\b"), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, wherever the optimizer moves or copies the expression.

    A column that lambdas refer to may be inlined by a pushed-down filter, and
    would then be computed again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(ws: Column, n: int) -> Column:
    whole = F.transform(ws, lambda w, i: F.concat_ws(" ", w, *(F.get(ws, i + j) for j in range(1, n))))
    return F.slice(whole, F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(0)))


def shingles(words_: Column, n: int = 3) -> Column:
    """Distinct n-word shingles; the distinct words if there are fewer than ``n``."""
    return let(words_, lambda ws: F.array_distinct(F.when(F.size(ws) < n, ws).otherwise(_runs(ws, n))))


def benchmark_words(text: Column) -> Column:
    """Lower case, all but a-z, 0-9 and white space become spaces, then split; no words give an empty array."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9\s]", " "), F.lit(r"\S+"), F.lit(0))


def ngrams(words_: Column, n: int = 13) -> Column:
    """n-word grams in order; empty if there are fewer words."""
    return let(words_, lambda ws: _runs(ws, n))


def synth_title(body: Column, most: int = 160) -> Column:
    """The first sentence if it has at most ``most`` characters, else its beginning."""
    first = F.trim(F.regexp_extract(F.trim(body), r"^([^\n]*?[.!?](?=\s|$)|[^\n]+)", 1))
    return F.when(first == "", F.lit(None)).when(F.char_length(first) <= most, first).otherwise(F.rtrim(F.substring(first, 1, most)))


def token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S+"), F.lit(0)))


def heading_key(text: Column) -> Column:
    """Letters and digits only, lower case: equal for headings that differ in punctuation."""
    return F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]+", "")


# What markup hides, and what ends a line.
HIDDEN = r"(?is)<(?:script|style|title)[^>]*>.*?</(?:script|style|title)>|<!--.*?-->"
BREAKS = r"(?i)<(?:br|/?(?:p|div|h[1-6]|li|ul|ol|tr|table|nav|article|section|header|footer|aside|body))(?:\s[^>]*)?/?>"


def markup_lines(markup: Column) -> Column:
    """Plain text of markup: a line per block, tags gone, white space folded, empty lines dropped. References stay."""
    broken = F.regexp_replace(F.regexp_replace(F.coalesce(markup, F.lit("")), HIDDEN, ""), BREAKS, "\n")
    lines = F.transform(F.split(F.regexp_replace(broken, r"<[^>]*>", ""), "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")
