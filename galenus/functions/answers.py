"""Answers in generated text, stated values, and checks of training examples."""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a choice is announced, and the forms of stated values.
ANNOUNCED = r"(?:correct option is|option|answer is|correct choice is|choice)\s*\(?([a-d])\)?"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: The written forms of values. At one place the first that fits is meant; what it takes is no part of another.
VALUE = re.compile(
    rf"""
      (?P<report> \b (?:EMEA/H/C/)? PSUSA/(?P<procedure>\d+)/(?P<period>\d+) \b )
    | (?P<trial> \b NCT\d{{8}} \b )
    | (?P<iso> \b (?P<iso_y>\d{{4}})-(?P<iso_m>\d\d)-(?P<iso_d>\d\d) \b )
    | (?P<slashed> (?<![\w/]) (?: \d{{4}}/\d{{1,2}}/\d{{1,2}} | \d{{1,2}}/\d{{1,2}}/\d{{4}} ) (?![\w/]) )
    | (?P<spoken> \b (?P<spoken_d>\d{{1,2}})[ ](?P<spoken_m>{"|".join(MONTHS)})[ ](?P<spoken_y>\d{{4}}) \b )
    | (?P<product> \b (?! (?:19|20)\d\d-(?:19|20)\d\d (?!-\d|\d) ) \d{{4,5}}-\d{{3,4}}(?:-\d{{1,2}})? \b )
    | (?P<article> \b (?i:PMID):?\s*(?P<article_no>\d+) \b )
    | (?P<substance> \b (?=[A-Z0-9]*\d)(?=[A-Z0-9]*[A-Z]) [A-Z0-9]{{10}} \b )
    | (?P<count> (?<![\w.\-/,]) (?: \d{{1,3}}(?:,\d{{3}})+ | \d{{2,}} ) (?! [\w\-/] | [.,]\d ) )""",
    re.X,
)
#: A number of a text that states values: one digit is enough, and a group of thousands also counts by its parts.
STATED_NUMBER = re.compile(r"(?<![\w.\-/:])\d+(?:,\d{3})*(?![\w\-/:]|\.\d)")
QUOTED = '"([^"]*)"|“([^”]*)”'


def choice_letter(text: Column) -> Column:
    """The last announced option, else the last lone letter a to d, else A."""
    low = F.lower(F.coalesce(text, F.lit("")))
    last = lambda p: F.try_element_at(F.regexp_extract_all(low, F.lit(p), F.lit(1)), F.lit(-1))
    return F.upper(F.coalesce(last(ANNOUNCED), last(r"\b([a-d])\b"), F.lit("a")))


def yes_no_maybe(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.contains(low, F.lit("yes")), "yes").when(F.contains(low, F.lit("no")), "no").otherwise("maybe")


def _dates(*orders: tuple[str, str, str]) -> set[str]:
    """ISO dates of those (year, month, day) that are days of the calendar."""
    out = set()
    for y, m, d in orders:
        with contextlib.suppress(ValueError):
            out.add(date(int(y), int(m), int(d)).isoformat())
    return out


@dataclass(frozen=True)
class Value:
    """A value of a text: as written, and all that it can mean. Two values agree if they share a meaning."""

    written: str
    meanings: frozenset[str]
    counted: bool
    start: int
    end: int

    @classmethod
    def of(cls, m: re.Match[str]) -> Value:
        kind, written = m.lastgroup, m[0]
        if kind == "iso":
            means = _dates((m["iso_y"], m["iso_m"], m["iso_d"]))
        elif kind == "spoken":
            means = _dates((m["spoken_y"], str(1 + MONTHS.index(m["spoken_m"])), m["spoken_d"]))
        elif kind == "slashed":
            a, b, c = written.split("/")
            means = _dates((a, b, c)) if len(a) == 4 else _dates((c, b, a), (c, a, b))  # day and month in either order
        elif kind == "report":
            means = {f"report {m['procedure']} {m['period']}"}
        elif kind == "article":
            written, means = m["article_no"], {f"article {m['article_no']}"}
        else:
            means = {f"number {written.replace(',', '')}"} if kind == "count" else set()
        return cls(written, frozenset(means or {f"as written {written}"}), kind == "count", *m.span())


def values_in(text: str) -> list[Value]:
    """Dates, identifiers and counts of a text, in order; none overlap."""
    return [Value.of(m) for m in VALUE.finditer(text)]


def stated_meanings(text: str) -> set[str]:
    """All that a text states: its values, the numbers between them, and each run of digits as an article's number."""
    fixed = [v for v in values_in(text) if not v.counted]
    out = {x for v in fixed for x in v.meanings} | {f"article {d}" for d in re.findall(r"\d+", text)}
    between = zip([0, *(v.end for v in fixed)], [*(v.start for v in fixed), len(text)], strict=True)
    for start, end in between:
        for number in STATED_NUMBER.findall(text[start:end]):
            out |= {f"number {n}" for n in (number.replace(",", ""), *number.split(","))}
    return out


def unstated(answer: str, known: Iterable[str]) -> list[str]:
    """Values that the answer states and no known text does, each once, in order. Dates compare by value."""
    stated = stated_meanings("\n".join(known))
    return list(dict.fromkeys(v.written for v in values_in(answer) if stated.isdisjoint(v.meanings)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def unstated_values(answer: pd.Series, known: pd.Series) -> pd.Series:
    """``known`` holds the texts, joined by line feeds."""
    return pd.Series([unstated(a or "", [k or ""]) for a, k in zip(answer, known, strict=True)])


def citation_problem(answer: Column, passage: Column, ref: Column) -> Column:
    """Null if every quoted span is in the passage and the reference is cited; else what is wrong."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    spans = F.transform(F.regexp_extract_all(answer, F.lit(QUOTED), F.lit(0)), lambda q: squeeze(F.regexp_replace(q, "^[\"“]|[\"”]$", "")))
    wrong = F.filter(spans, lambda q: (q == "") | ~F.contains(squeeze(passage), q))
    return (
        F.when(F.size(F.filter(spans, lambda q: q != "")) == 0, "answer has no quoted span")
        .when(F.size(wrong) > 0, F.concat(F.lit("quote not in passage: "), F.get(wrong, F.lit(0))))
        .when(~F.contains(answer, F.concat(F.lit("["), ref, F.lit("]"))), "answer does not cite its reference")
    )


def loads_strict(text: str):
    """JSON in which no object repeats a key; ValueError otherwise."""

    def once(pairs: list[tuple]) -> dict:
        if len(dict(pairs)) < len(pairs):
            raise ValueError("duplicate key")
        return dict(pairs)

    return json.loads(text, object_pairs_hook=once)


@F.pandas_udf(T.BooleanType())
def is_strict_json(text: pd.Series) -> pd.Series:
    def ok(t: str | None) -> bool:
        try:
            loads_strict(t or "")
        except ValueError:
            return False
        return True

    return text.map(ok)
