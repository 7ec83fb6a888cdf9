"""Canonical JSON, digests and payload paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(fields: dict[str, Column]) -> Column:
    """Compact JSON object with sorted keys; null fields stay out."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))


def digest(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical(fields), 256)


def payload_text(payload: Column, *path: str) -> Column:
    """Text at a path of a JSON string; numbers and nested values as text."""
    return F.get_json_object(payload, "$." + ".".join(path))


def payload_values(payload: Column, path: str) -> Column:
    """Distinct stripped values at a dotted path that may cross arrays; [*] marks an array step."""
    raw = F.get_json_object(payload, f"$.{path}")
    many = F.from_json(raw, "array<string>")
    found = F.when(raw.startswith("["), many).when(raw.isNotNull(), F.array(raw))
    return F.array_distinct(F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: v != ""))


def sorted_names(names: Column) -> Column:
    """Sorted distinct stripped names without blanks."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != "")))


def inverted_index_text(index: Column) -> Column:
    """Text of a map word -> positions."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    text = F.array_join(F.transform(F.array_sort(pairs), lambda p: p["word"]), " ")
    return F.when(text != "", text)
